"""Composition keys: parsing, reduction and canonical spelling of formulas, and the systems they belong to.

A composition is a ``map<string, int>`` of counts; maps can be neither grouped nor joined on, so the canonical string is
the key: symbols in code-point order, each with its explicit count.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The symbols of the elements, in order.
ELEMENTS = (
    "H He Li Be B C N O F Ne Na Mg Al Si P S Cl Ar K Ca Sc Ti V Cr Mn Fe Co Ni Cu Zn Ga Ge As Se Br Kr Rb Sr Y Zr Nb Mo Tc Ru Rh Pd Ag Cd In Sn Sb Te I Xe "
    "Cs Ba La Ce Pr Nd Pm Sm Eu Gd Tb Dy Ho Er Tm Yb Lu Hf Ta W Re Os Ir Pt Au Hg Tl Pb Bi Po At Rn Fr Ra Ac Th Pa U Np Pu Am Cm Bk Cf Es Fm Md No Lr Rf Db Sg Bh Hs Mt Ds Rg Cn Nh Fl Mc Lv Ts Og"
).split()
#: The lanthanides; scandium and yttrium have no f electrons and aren't among them.
RARE_EARTHS = ("La", "Ce", "Pr", "Nd", "Pm", "Sm", "Eu", "Gd", "Tb", "Dy", "Ho", "Er", "Tm", "Yb", "Lu")
_TOKEN = re.compile(r"(?P<open>\()|(?P<close>\))(?P<times>\d*)|(?P<symbol>[A-Z][a-z]?)(?P<count>\d*)|(?P<gap>[\s_-]+)")
COUNTS = T.MapType(T.StringType(), T.LongType())


def parse_text(text: str) -> dict[str, int]:
    """Counts of a formula with nested groups; blanks, tabs, ``_`` and ``-`` separate. Raises ValueError with the place of a fault."""
    known, stack, at = set(ELEMENTS), [{}], 0
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            raise ValueError(f"unexpected {text[at]!r} at position {at} of {text!r}")
        if m["open"]:
            stack.append({})
        elif m["close"]:
            if len(stack) == 1:
                raise ValueError(f"unmatched ')' at position {at} of {text!r}")
            inner, times = stack.pop(), int(m["times"] or 1)
            for symbol, n in inner.items():
                stack[-1][symbol] = stack[-1].get(symbol, 0) + n * times
        elif m["symbol"]:
            if m["symbol"] not in known:
                raise ValueError(f"unknown element {m['symbol']!r} at position {at} of {text!r}")
            stack[-1][m["symbol"]] = stack[-1].get(m["symbol"], 0) + int(m["count"] or 1)
        at = m.end()
    if len(stack) > 1:
        raise ValueError(f"unclosed '(' in {text!r}")
    if not stack[0]:
        raise ValueError(f"no element in {text!r}")
    return stack[0]


@F.pandas_udf(T.StructType([T.StructField("counts", COUNTS), T.StructField("error", T.StringType())]))
def parse_nested(texts: pd.Series) -> pd.DataFrame:
    """struct(counts, error) of formulas that may nest groups; a fault gives null counts and its message."""

    def one(text: str | None) -> tuple[dict | None, str | None]:
        if text is None:
            return None, None
        try:
            return parse_text(text), None
        except ValueError as e:
            return None, str(e)

    return pd.DataFrame([one(t) for t in texts], columns=["counts", "error"])


def parse_flat(text: Column) -> Column:
    """Counts of a formula without groups, by built-in functions; null where anything but symbols, counts and gaps is left."""
    plain = F.regexp_replace(text, r"[\s_-]+", "")
    symbols = F.regexp_extract_all(plain, F.lit(r"([A-Z][a-z]?)(\d*)"), F.lit(1))
    numbers = F.transform(F.regexp_extract_all(plain, F.lit(r"([A-Z][a-z]?)(\d*)"), F.lit(2)), lambda n: F.when(n == "", F.lit(1)).otherwise(n.cast("long")))
    distinct = F.array_sort(F.array_distinct(symbols))
    total = lambda s: F.aggregate(F.zip_with(symbols, numbers, lambda a, n: F.when(a == s, n).otherwise(F.lit(0))), F.lit(0).cast("long"), lambda x, y: x + y)
    whole = plain.rlike(r"^([A-Z][a-z]?\d*)+$") & (F.size(F.array_except(distinct, F.array(*map(F.lit, ELEMENTS)))) == 0)
    return F.when(whole, F.map_from_arrays(distinct, F.transform(distinct, total)))


def gcd_of(values: Column) -> Column:
    """Greatest common divisor of positive counts; 1 for none. Euclid's steps, folded: 64-bit numbers need 91 at most, few of them as a rule."""
    pair = lambda a, b: F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    step = lambda p, _: F.when(p["b"] == 0, p).otherwise(pair(p["b"], p["a"] % F.nullif(p["b"], F.lit(0))))
    # a remainder at least halves in two steps
    steps = lambda a, b: F.sequence(F.lit(1), F.ceil(2 * F.log2(F.least(a, b) + 1) + 2).cast("int"))
    gcd = lambda a, b: F.aggregate(steps(a, b), pair(a, b), step, lambda p: p["a"])
    return F.when(F.size(values) > 0, F.aggregate(values, F.element_at(values, 1).cast("long"), lambda a, v: gcd(a, v.cast("long")))).otherwise(F.lit(1).cast("long"))


def reduced(counts: Column) -> Column:
    d = gcd_of(F.map_values(counts))
    return F.transform_values(counts, lambda _, v: (v / d).cast("long"))


def canonical(counts: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(F.map_entries(counts)), lambda e: F.concat(e["key"], e["value"].cast("string"))), "")


def chemsys(counts: Column) -> Column:
    return F.array_join(F.array_sort(F.map_keys(counts)), "-")


def n_atoms(counts: Column) -> Column:
    return F.aggregate(F.map_values(counts), F.lit(0).cast("long"), lambda a, v: a + v)


def identity(counts: Column) -> Column:
    """struct(formula, z, chemsys, n_atoms): the reduced canonical formula, its formula units, its system."""
    return F.struct(canonical(reduced(counts)).alias("formula"), gcd_of(F.map_values(counts)).alias("z"), chemsys(counts).alias("chemsys"), n_atoms(counts).alias("n_atoms"))


def counts_of(symbols: Column, only: Column | None = None) -> Column:
    """Counts of a list of symbols, of those in ``only`` if given."""
    distinct = F.array_sort(F.array_distinct(symbols if only is None else F.array_intersect(symbols, only)))
    return F.map_from_arrays(distinct, F.transform(distinct, lambda s: F.size(F.filter(symbols, lambda x: x == s)).cast("long")))


def subsystems(elements: Column) -> Column:
    """All non-empty subsets of a sorted list, as ``-``-joined keys: 2 ** k of them, so for short lists."""
    # each element doubles the subsets so far, the empty one (null) first
    grown = lambda acc, e: F.concat(acc, F.transform(acc, lambda s: F.coalesce(F.concat(s, F.lit("-"), e), e)))
    return F.aggregate(elements, F.array(F.lit(None).cast("string")), grown, lambda acc: F.array_compact(acc))


def target_count(n: Column, fixed: Column | None = None, per_atom: Column | None = None) -> Column:
    """A fixed target, or at least 1 and the half-even rounding of a rate times the size."""
    return fixed if fixed is not None else F.greatest(F.lit(1).cast("long"), F.bround(per_atom * n).cast("long"))


def group_fraction(counts: Column, group: list[str]) -> Column:
    """Share of the atoms that are of a group."""
    inside = F.map_filter(counts, lambda k, _: k.isin(*group))
    return F.try_divide(n_atoms(inside).cast("double"), n_atoms(counts).cast("double"))


def correction_risk(chemsys: Column, anions: tuple[str, ...], u_elements: tuple[str, ...]) -> Column:
    """struct(anions, u): which elements of a system are corrected anions, and which metals get a U beside oxygen or fluorine."""
    elements = F.split(chemsys, "-")
    oxide = F.array_contains(elements, "O") | F.array_contains(elements, "F")
    none = F.array().cast("array<string>")
    return F.struct(F.array_intersect(elements, F.array(*map(F.lit, anions))).alias("anions"), F.when(oxide, F.array_intersect(elements, F.array(*map(F.lit, u_elements)))).otherwise(none).alias("u"))


def slug(text: Column, length: int = 60) -> Column:
    return F.substring(F.regexp_replace(F.regexp_replace(text, "[^A-Za-z0-9._-]+", "-"), "^-+|-+$", ""), 1, length)
