"""Scalar rules on columns: drifts, bands, interpolation, durations, sizes, ranges, hashes, splits and ladders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def drift(before: Column, after: Column) -> Column:
    """(after - before) / before; null where before is 0 or null or after is null."""
    return F.try_divide(after - before, F.nullif(before, F.lit(0.0)))


def half_even(value: Column, digits: int = 0) -> Column:
    return F.bround(value, digits)


def ladder(*steps: tuple[Column, object], otherwise: object = None) -> Column:
    """The value of the first step that holds: ``(condition, value)``, most serious first."""
    out = otherwise if isinstance(otherwise, Column) else F.lit(otherwise)
    for condition, value in reversed(steps):
        out = F.when(condition, value if isinstance(value, Column) else F.lit(value)).otherwise(out)
    return out


def exit_reason(error: Column, converged: Column) -> Column:
    return ladder((F.coalesce(error, F.lit("")) != "", error), (~F.coalesce(converged, F.lit(False)), "step_limit"), otherwise="")


def band(distance: Column, edges: tuple[float, ...] = (0.0, 0.06, 0.2)) -> Column:
    """Index of the first edge that the distance does not exceed; as many as edges beyond the last."""
    return ladder((distance.isNull(), F.lit(None).cast("int")), *((distance <= e + 1e-12, i) for i, e in enumerate(edges)), otherwise=len(edges))


def core_hours(elapsed_s: Column, cpus: Column) -> Column:
    return elapsed_s * cpus / 3600.0


#: Units of magnetisation (mu_B per cubic angstrom to tesla and emu/cc) and the polarisation of a common magnet.
TESLA, EMU, MAGNET = 11.654064, 9274.0100783, 1.61


def magnetisation(moment: Column, volume: Column) -> dict[str, Column]:
    m = F.try_divide(F.abs(moment), F.nullif(volume, F.lit(0.0)))
    return {"m_per_volume": m, "mu0_m_tesla": m * TESLA, "m_emu_cc": m * EMU, "fraction_of_magnet": m * TESLA / MAGNET}


def seconds(text: Column, bare: int = 1) -> Column:
    """Seconds of ``D-HH:MM:SS``, ``HH:MM:SS``, ``MM:SS`` or a bare number of units of ``bare`` seconds; null for anything else."""
    days = F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(text, r"^(\d+)-", 1), F.lit("")), F.lit("999999")).cast("double"), F.lit(0.0))
    clock = F.split(F.regexp_replace(text, r"^\d+-", ""), ":")
    total = F.aggregate(clock, F.lit(0.0), lambda a, x: a * 60 + x.cast("double"))
    scale = F.when(F.size(clock) == 1, F.when(text.rlike(r"^\d+-"), F.lit(3600.0)).otherwise(F.lit(float(bare)))).when((F.size(clock) == 2) & text.rlike(r"^\d+-"), F.lit(60.0)).otherwise(F.lit(1.0))
    return F.when(text.rlike(r"^(\d+-)?\d+(:\d+){0,2}(\.\d+)?$"), days * 86400 + total * scale)


def megabytes(text: Column) -> Column:
    """``32G``, ``512M``, ``1T``, ``2048K`` or bare megabytes; null for anything else."""
    unit = F.upper(F.regexp_extract(text, r"([KMGT]?)B?$", 1))
    times = F.when(unit == "K", 1 / 1024).when(unit == "G", 1024.0).when(unit == "T", 1024.0 * 1024).otherwise(1.0)
    return F.when(text.rlike(r"(?i)^\d+(\.\d+)?[KMGT]?B?$"), F.regexp_extract(text, r"^(\d+(?:\.\d+)?)", 1).cast("double") * times)


def array_range(text: Column) -> Column:
    """Task numbers of ``[0-5,7%2]``, ``3`` or ``0-8:2``, in order; a throttle after ``%`` is dropped."""
    body = F.split(F.regexp_replace(F.regexp_replace(text, r"%\d+", ""), r"[\[\]\s]", ""), ",")

    def expand(part: Column) -> Column:
        low = F.regexp_extract(part, r"^(\d+)", 1).cast("int")
        high = F.coalesce(F.nullif(F.regexp_extract(part, r"-(\d+)", 1), F.lit("")).cast("int"), low)
        step = F.coalesce(F.nullif(F.regexp_extract(part, r":(\d+)", 1), F.lit("")).cast("int"), F.lit(1))
        return F.sequence(low, high, step)

    return F.flatten(F.transform(F.filter(body, lambda p: p.rlike(r"^\d+(-\d+(:\d+)?)?$")), expand))


def exit_code(text: Column) -> Column:
    """struct(code, signal) of ``e:s``."""
    return F.struct(F.nullif(F.regexp_extract(text, r"^(\d+)", 1), F.lit("")).cast("int").alias("code"), F.coalesce(F.nullif(F.regexp_extract(text, r":(\d+)", 1), F.lit("")).cast("int"), F.lit(0)).alias("signal"))


def content_hash(content: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.left(F.sha2(content, 256), F.lit(16)))


def fingerprint(*parts: Column) -> Column:
    return F.left(F.sha1(F.concat_ws("|", *(p.cast("string") for p in parts))), F.lit(12))


def last_match(text: Column, pattern: str, group: int = 1) -> Column:
    """The group of the last match in a log; null without one."""
    return F.try_element_at(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.lit(-1))


def head_bytes(content: Column, n: int) -> Column:
    return F.substring(content, 1, n)


def tail_bytes(content: Column, n: int) -> Column:
    return F.substring(content, -n, n)


def split_batches(target: Column, cap: int) -> Column:
    """ceil(target / cap) parts that differ by 1 at most and sum to the target; none for 0."""
    n = F.ceil(target / cap).cast("int")
    base, rest = F.floor(target / n).cast("long"), target % n
    parts = F.transform(F.sequence(F.lit(0), n - 1), lambda i: base + F.when(i < rest, 1).otherwise(0))
    return F.when(target > 0, parts).otherwise(F.array().cast("array<bigint>"))


def chunks(total: Column, size: int) -> Column:
    """[(start, end)] with both ends inside, each of at most ``size``."""
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), total - 1, F.lit(size).cast("long")), lambda s: F.struct(s.alias("start"), F.least(s + size - 1, total - 1).alias("end")))
    return F.when(total > 0, pairs).otherwise(F.array().cast("array<struct<start:bigint,end:bigint>>"))


def ceil_to(value: Column, multiple: int) -> Column:
    return F.ceil(value / multiple) * multiple


def n_bands(electrons: Column, ions: Column, group: int = 4) -> Column:
    """Bands for so many electrons: half of them and some for the ions, at least six tenths, up to the next multiple of a group; null
    without electrons. Fixed values: 10, 2, 0.6."""
    half = F.floor(electrons / 2) + F.greatest(F.floor(ions / 2), F.lit(10))
    return F.when(electrons > 0, ceil_to(F.greatest(half, F.floor(electrons * 0.6)), max(1, group)).cast("long"))


def queue_limits(line: Column) -> Column:
    """struct(submit, jobs, cpus, gpus) of a line ``submit|jobs|cpu=n,gres/gpu=n``; null where a limit isn't set."""
    part = lambda n: F.get(F.split(line, r"\|"), F.lit(n))
    number = lambda text, pattern: F.nullif(F.regexp_extract(F.coalesce(text, F.lit("")), pattern, 1), F.lit("")).cast("long")
    return F.struct(number(part(0), r"^(\d+)$").alias("submit"), number(part(1), r"^(\d+)$").alias("jobs"), number(part(2), r"(?:^|,)cpu=(\d+)").alias("cpus"), number(part(2), r"(?:^|,)gres/gpu=(\d+)").alias("gpus"))


def memory_gb(n: Column, spins: Column, k: Column, base: float, per_spin: float, per_k: float, floor: int = 16, multiple: int = 8) -> Column:
    """A linear estimate with an interaction, up to the next multiple, at least ``floor``."""
    return F.greatest(ceil_to(base + per_spin * n * spins + per_k * n * spins * k / 1000.0, multiple), F.lit(floor)).cast("long")


def divisors(n: Column) -> Column:
    return F.filter(F.sequence(F.lit(1), n), lambda d: n % d == 0)


def k_parallel(k_points: Column, cores: Column, most: int = 16) -> Column:
    """The divisor of the cores that needs the fewest rounds of k-points, the smaller on ties."""
    rank = lambda d: F.struct(F.ceil(k_points / d).alias("rounds"), d.alias("d"))
    return F.array_min(F.transform(F.filter(divisors(cores), lambda d: d <= most), rank))["d"]


def k_grid(lengths: Column, spacing: float) -> Column:
    """Points along each reciprocal axis at most ``spacing`` apart, 1 at least."""
    return F.transform(lengths, lambda b: F.greatest(F.lit(1), F.ceil(b / spacing)).cast("int"))


def lattice_parameters(cell: Column) -> Column:
    """struct(a, b, c, alpha, beta, gamma) of three cell vectors, angles in degrees."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    v = [F.element_at(cell, i) for i in (1, 2, 3)]
    n = [F.sqrt(dot(x, x)) for x in v]
    angle = lambda i, j: F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.try_divide(dot(v[i], v[j]), n[i] * n[j])))))
    return F.struct(*(x.alias(k) for x, k in zip(n, "abc", strict=True)), angle(1, 2).alias("alpha"), angle(0, 2).alias("beta"), angle(0, 1).alias("gamma"))


def remedy(state: Column, code: Column) -> Column:
    """What a failed job needs, by state and exit code."""
    return ladder((state == "timeout", "more_time"), ((state == "out_of_memory") | (code == 125), "more_memory"), (code == 127, "fix_environment"), (state == "failed", "retry"), otherwise=None)


def rule_for(triggers: Column, rules: list[tuple[str, str]]) -> Column:
    """The action of the first rule, in order, whose trigger is among the triggers."""
    return ladder(*((F.array_contains(triggers, when), action) for when, action in rules), otherwise=F.lit(None).cast("string"))


def json_field(text: Column, path: str, kind: str) -> Column:
    """A field of a JSON text, null where the text is malformed."""
    return F.get_json_object(text, path).try_cast(kind)
