"""Rules on one record: energies and corrections, moments, cells, geometry, logs, seeds and texts, as columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from funnelspark.functions.formula import n_atoms
from funnelspark.functions.values import TESLA, ladder

#: Hund's-rule moments g_J * J of the trivalent lanthanides, in Bohr magnetons; the light ones add to the host, the heavy ones subtract.
HUND = {"La": 0.00, "Ce": 2.14, "Pr": 3.20, "Nd": 3.27, "Pm": 2.40, "Sm": 0.71, "Eu": 0.00, "Gd": 7.00, "Tb": 9.00, "Dy": 10.00, "Ho": 10.00, "Er": 9.00, "Tm": 7.00, "Yb": 4.00, "Lu": 0.00}
LIGHT = ("La", "Ce", "Pr", "Nd", "Pm", "Sm", "Eu")
#: Signed site moments of the rare earths for the polarisation of a ranked list.
SITE_MOMENT = {"Y": 0.0, "La": 0.0, "Ce": -1.47, "Nd": 2.47, "Pr": 2.23, "Sm": 0.44, "Dy": -10.21, "Tb": -9.00, "Gd": -7.00}
#: Bounds of a plausible cell, in angstrom and degrees.
CELL = {"least": 1.0, "most": 50.0, "least_angle": 10.0, "most_angle": 170.0, "contact": 0.5}
_NUMBER_LIKE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^(True|False)$"


def _table(values: dict[str, float]) -> Column:
    return F.create_map(*(F.lit(x) for pair in values.items() for x in pair))


# --- energies --------------------------------------------------------------------------------------------------------


def per_atom(total: Column, n: Column) -> Column:
    return F.try_divide(total, F.nullif(n, F.lit(0)))


def volume_per_atom(volume: Column, n: Column) -> Column:
    return F.bround(per_atom(volume, n), 4)


def correction(corrected: Column, raw: Column) -> Column:
    """What a third source adds to a raw energy; null where either is missing."""
    return corrected - raw


def corrected_per_atom(epa: Column, counts: Column, deltas: dict[str, float]) -> Column:
    """Energy an atom with each element's shift times its share; elements without a shift add nothing."""
    shift = F.aggregate(F.map_entries(counts), F.lit(0.0), lambda a, e: a + e["value"] * F.coalesce(F.try_element_at(_table(deltas), e["key"]), F.lit(0.0)))
    return epa + per_atom(shift, n_atoms(counts))


def energy_of(source: Column, ready: Column, static: Column, mlip: Column, mp_per_atom: Column, mp_atoms: Column) -> Column:
    """Total energy on the asked source: ``dft`` only of ready rows, ``mlip`` as relaxed, ``mp`` per atom times its atoms; else null."""
    return F.when(source == "dft", F.when(ready, static)).when(source == "mlip", mlip).when(source == "mp", mp_per_atom * F.nullif(mp_atoms, F.lit(0)))


def cell_counts(own_atoms: Column, counts: Column, atoms: Column, read: Column) -> Column:
    """Counts of our cell: a reference's counts times the ratio of sizes where that is whole, else those read from the geometry."""
    q = F.try_divide(own_atoms.cast("double"), F.nullif(atoms, F.lit(0)))
    whole = (F.abs(q - F.round(q)) < 1e-9) & (F.size(counts) > 0) & (own_atoms > 0)
    return F.when(F.coalesce(whole, F.lit(False)), F.transform_values(counts, lambda _, n: (n * F.round(q)).cast("long"))).otherwise(read)


# --- moments ---------------------------------------------------------------------------------------------------------


def hund_moment(tm: Column, counts: Column, treatment: Column) -> Column:
    """Moment of the host with that of the rare earths where they are frozen; other treatments hold the 4f moment already, or want none."""
    signed = _table({k: v if k in LIGHT else -v for k, v in HUND.items()})
    add = F.aggregate(F.map_entries(counts), F.lit(0.0), lambda a, e: a + F.when(e["value"] > 0, e["value"] * F.try_element_at(signed, e["key"])).otherwise(0.0))
    known = F.forall(F.map_keys(counts), lambda k: F.map_contains_key(signed, k))
    add = F.when(known, add).otherwise(F.raise_error(F.lit("no Hund's-rule moment of a rare earth")).cast("double"))
    return tm + F.when(treatment == "frozen", add).otherwise(0.0)


def corrected_polarisation(moment: Column, counts: Column, atoms: Column, volume: Column) -> Column:
    """mu0 Ms in tesla of a host moment with the rare earths' site moments, a formula's counts scaled to the cell's atoms."""
    add = F.aggregate(F.map_entries(counts), F.lit(0.0), lambda a, e: a + e["value"] * F.coalesce(F.try_element_at(_table(SITE_MOMENT), e["key"]), F.lit(0.0)))
    return F.try_divide(TESLA * (moment + per_atom(add * atoms, n_atoms(counts))), F.nullif(volume, F.lit(0.0)))


def frozen_visible(re_moments: Column, most: float = 0.5) -> Column:
    """Whether all rare-earth sites stay below a moment; false without any."""
    return (F.size(re_moments) > 0) & F.forall(re_moments, lambda m: F.abs(m) < most)


def sphere_deficit(cell: Column, spheres: Column) -> Column:
    return cell - spheres


def per_formula_unit(cell: Column, z: Column) -> Column:
    return F.when(z > 0, cell / z)


def per_volume(cell: Column, volume: Column) -> Column:
    return F.when(volume > 0, cell / volume)


def channels(site: Column, names: tuple[str, ...] = ("s", "p", "d", "f")) -> Column:
    """A site's moments by channel, all of them, a missing one as 0.0."""
    return F.struct(*(F.coalesce(F.try_element_at(site, F.lit(c)), F.lit(0.0)).alias(c) for c in names))


# --- cells and geometry ----------------------------------------------------------------------------------------------


def ternary_xy(b: Column, c: Column) -> tuple[Column, Column]:
    """Place of shares a, b, c in a triangle of side 1, a at the origin."""
    return b + c / 2, c * (math.sqrt(3) / 2)


def volume_scale(old: Column, new: Column, radii: dict[str, float]) -> Column:
    """Ratio of the sums of cubed radii of two compositions: how far a cell grows as its species are swapped."""
    cubes = lambda counts: F.aggregate(F.map_entries(counts), F.lit(0.0), lambda a, e: a + e["value"] * F.pow(F.element_at(_table(radii), e["key"]), F.lit(3.0)))
    return cubes(new) / cubes(old)


def swapped(counts: Column, hosts: list[str], target: Column) -> Column:
    """Counts with all of the host species taken by one target."""
    inside = F.map_filter(counts, lambda k, _: k.isin(*hosts))
    rest = F.map_filter(counts, lambda k, _: ~k.isin(*hosts))
    return F.map_concat(F.map_filter(rest, lambda k, _: k != target), F.map_from_arrays(F.array(target), F.array(n_atoms(inside) + F.coalesce(F.try_element_at(rest, target), F.lit(0).cast("long")))))


def geometry_fault(atoms: Column, lengths: Column, angles: Column, volume: Column, closest: Column, most: float = CELL["most"]) -> Column:
    """Why a cell isn't handed on, the first reason that holds; empty if none does."""
    finite = lambda v: F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    beyond = lambda v, low, high: F.exists(v, lambda x: (x < low) | (x > high))
    return ladder(
        (F.coalesce(atoms, F.lit(0)) == 0, "rejected:no_atoms"),
        (~finite(lengths), "rejected:lengths_unknown"),
        (beyond(lengths, CELL["least"], most), "rejected:lengths"),
        (~finite(angles), "rejected:angles_unknown"),
        (beyond(angles, CELL["least_angle"], CELL["most_angle"]), "rejected:angles"),
        (volume <= 0, "rejected:volume"),
        ((atoms > 1) & (closest < CELL["contact"]), "rejected:contact"),
        otherwise="",
    )


def composition_mismatch(asked: Column, made: Column) -> Column:
    """Whether a generated structure's canonical formula isn't the one asked for."""
    return ~asked.eqNullSafe(made)


# --- logs and states -------------------------------------------------------------------------------------------------


def job_outcome(exists: Column, finished: Column, reached: Column, nsw: Column, ibrion: Column, nelm: Column, n_elec: Column, n_ionic: Column) -> Column:
    """struct(state, converged, reason) of a run, the reason as a short code (empty where the result can be used).

    converged asks two things: that the last electronic loop stayed below its limit, and that the log says the forces are met, or,
    where nothing was to move, that the run came to its end. Fixed values: the states, and the codes of the two limits."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    static = yes(nsw <= 0) | yes(ibrion == -1)
    scf = ~(yes(nelm != 0) & yes(n_elec != 0) & yes(n_elec >= nelm))
    converged = (yes(reached) | static & yes(finished)) & scf
    state = ladder((~yes(exists), "failed"), (~yes(finished), "timeout"), otherwise="done")
    reason = ladder(
        (~yes(exists), "no_log"),
        (~yes(finished), "cut_off"),
        (converged, ""),
        (~scf, "scf_not_converged"),
        (yes(n_ionic >= nsw), "ionic_step_limit"),
        otherwise="force_limit_not_met",
    )
    return F.struct(state.alias("state"), converged.alias("converged"), reason.alias("reason"))


def log_marks(text: Column) -> dict[str, Column]:
    """What the classifiers look for in a log: how it ended, convergence, the bracketing fault and fatal blocks."""
    return {"finished": F.contains(text, F.lit("General timing and accounting")), "reached": F.contains(text, F.lit("reached required accuracy")), "bracketing": F.contains(text, F.lit("ZBRENT")), "fatal": text.rlike("(?i)internal error|very serious problems"), "illegal": F.contains(F.lower(text), F.lit("illegal instruction"))}


def failure_bucket(inputs: Column, outcar: Column, vasp_out: Column, illegal: Column, outcome: Column, bracketing: Column, fatal: Column, age_s: Column, ignored: Column, setup_error: Column, running_s: float = 1800.0) -> Column:
    """One of the buckets that outstanding runs are counted in; what the store ignores and what never got its inputs come first."""
    return ladder(
        (ignored, "ignored"),
        (~inputs & setup_error.isNotNull(), "setup_error"),
        (~inputs, "not_started"),
        (~outcar & ~vasp_out, "staged"),
        (~outcar & illegal, "avx512"),
        (~outcar, "no_outcar"),
        ((outcome["state"] == "done") & outcome["converged"], "ok"),
        (outcome["reason"] == "ionic_step_limit", "max_steps"),
        (bracketing, "zbrent"),
        (fatal, "crash"),
        ((outcome["state"] == "timeout") & (age_s < running_s), "running"),
        (outcome["state"] == "timeout", "killed"),
        otherwise="not_conv",
    )


def projected_steps(steps: Column, elapsed: Column, left: Column) -> Column:
    """Steps that fit at the rate so far; null before the second step."""
    return F.when((steps > 1) & (elapsed > 0), steps + F.floor(left / (elapsed / steps)).cast("long"))


def health(age_s: Column, energy: Column, d_energy: Column, relax_ok: Column, stage: Column, steps: Column, elapsed: Column, converged: Column, last_scf: Column, nelm: Column, nsw: Column, projection: Column, stall_s: float = 3600.0) -> Column:
    """The verdict of the highest severity among the rules that hold for a live run, ok if none does.

    Fixed values: names, order of severity and thresholds."""
    moves, half = nsw != 0, F.greatest(F.floor(nelm / 2), F.lit(20))
    rules = [
        (10, "stalled", age_s > stall_s),
        (9, "DIVERGED", F.greatest(F.coalesce(energy, F.lit(0.0)), F.coalesce(d_energy, F.lit(0.0)) - 1.0) > 0),
        (8, "static-on-bad-relax", ~relax_ok),
        (7, "first-scf", (stage == "relax") & (steps == 0) & (elapsed > 3600)),
        (6, "converged", converged),
        (5, "scf-hard", last_scf >= nelm),
        (4, "nsw-limit", moves & (steps >= nsw)),
        (3, "slow", moves & (projection < nsw)),
        (2, "scf-hard", last_scf > half),
        (1, "nsw-limit", moves & projection.isNotNull() & (steps > 0.9 * nsw)),
    ]
    held = [F.when(holds, F.struct(F.lit(severity).alias("severity"), F.lit(name).alias("name"))) for severity, name, holds in rules]
    return F.coalesce(F.array_max(F.array(*held))["name"], F.lit("ok"))


def gpu_minutes(structures: Column, seconds_each: float = 1.5) -> Column:
    return F.ceil(structures * seconds_each) / 60.0


def stale_minutes(written: Column, now: Column) -> Column:
    return F.timestamp_diff("MINUTE", written, now)


def age_text(seconds: Column) -> Column:
    """An age in its largest whole unit."""
    unit = lambda n, name: F.concat(F.floor(seconds / n).cast("string"), F.lit(name))
    return F.when(seconds < 60, unit(1, "s")).when(seconds < 3600, unit(60, "m")).when(seconds < 86400, unit(3600, "h")).otherwise(unit(86400, "d"))


# --- seeds, settings, texts ------------------------------------------------------------------------------------------


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, "[^/]+$", 0)


def provenance_line(is_parent: Column, parent: Column, method: Column, varies: Column, tag: Column) -> Column:
    """Where a seed comes from, as name=value pairs of what its record knows, in a fixed order; blank fields are left out."""
    pair = lambda name, c: F.when(F.trim(c) != "", F.concat(F.lit(f"{name}="), c))
    kind = F.when(F.coalesce(is_parent, F.lit(False)), "parent").otherwise("child")
    made = [F.when(kind == "child", pair(name, c)) for name, c in (("changed", varies), ("method", method), ("route", tag))]
    return F.concat_ws("; ", pair("kind", kind), pair("of", parent), *made)


def key_fault(key: Column, value: Column, reserved: tuple[str, ...], elements: tuple[str, ...]) -> Column:
    """Why a key-value pair can't be stored, the first reason that holds; null if none does."""
    symbols = F.regexp_extract_all(key, F.lit(r"([A-Z][a-z]?)\d*"), F.lit(1))
    formula = key.rlike(r"^([A-Z][a-z]?\d*)+$") & (F.size(F.array_except(symbols, F.array(*map(F.lit, elements)))) == 0)
    return ladder((value.isNull(), "null"), (value.rlike(_NUMBER_LIKE), "number-like"), (key.isin(*reserved), "reserved"), (formula, "formula-like"))


def short_reason(text: Column) -> Column:
    """A message as a heading to count by: up to its first full stop, list in brackets or count of others, less what leads to these."""
    heading = F.regexp_replace(text, r"(?s)(?:\. | among |(?<!^)\[).*$", "")
    return F.regexp_replace(heading, r"(?:\s+(?:for|in|of|among|at))*\s*$", "")


def inherited(parent: Column, child: Column) -> Column:
    """A recipe's settings with a child's put over them; both are maps."""
    return F.map_concat(F.map_filter(parent, lambda k, _: ~F.map_contains_key(child, k)), child)


def merged_exclusions(old: Column, new: Column) -> Column:
    """Reasons by key: what is on file keeps its reason, new keys are added."""
    return F.map_concat(old, F.map_filter(new, lambda k, _: ~F.map_contains_key(old, k)))


def backoff_seconds(attempt: Column, first: float = 5.0, most: float = 480.0) -> Column:
    """Wait before a further try: doubled from the first, at most the last."""
    return F.least(F.lit(first) * F.pow(F.lit(2.0), attempt), F.lit(most))


def transient(message: Column) -> Column:
    """Whether a storage fault may pass by itself; anything else is never tried again."""
    return F.coalesce(message.rlike("(?i)locked|busy|stale file handle|disk i/o|timed? ?out|temporarily"), F.lit(False))


def resolved_item(counts: Column, explicit: Column) -> Column:
    """struct(z, status) of a composition item: ``ambiguous`` where a formula isn't reduced and z is given too, ``multiplied``
    where its own multiplier becomes z, else ``reduced`` with the z that is given (null: the source's)."""
    from funnelspark.functions.formula import gcd_of

    own = gcd_of(F.map_values(counts))
    status = ladder(((own != 1) & explicit.isNotNull(), "ambiguous"), (own != 1, "multiplied"), otherwise="reduced")
    return F.struct(F.when(status == "multiplied", own).when(status == "reduced", explicit).alias("z"), status.alias("status"))


def pilot_hold(policy: str, verdict: Column, has_pilot: Column) -> Column:
    """Why work outside the pilot waits; empty if it doesn't."""
    if policy != "block":
        return F.lit("")
    return ladder((verdict.isNull() & has_pilot, "waiting for the pilot"), (verdict == "fail", "pilot failed"), otherwise="")


def pilot_verdict(parity: Column, shared: Column, n: Column, least: float = 0.5) -> Column:
    """Verdict over parity and selection: fail where too little of the better method's top is found, warn where not all is."""
    share = F.try_divide(shared, F.nullif(n, F.lit(0)))
    return F.when(F.coalesce(share < least, F.lit(False)), "fail").when(F.coalesce(share < 1, F.lit(False)) & (parity == "pass"), "warn").otherwise(parity)


def selected_flag(marked: Column, state: Column) -> Column:
    """Whether a structure was selected: by its mark, or by having gone on from there."""
    return F.coalesce(marked, F.lit(False)) | F.coalesce(state.isin("selected", "dft_queued", "dft_running", "dft_done"), F.lit(False))
