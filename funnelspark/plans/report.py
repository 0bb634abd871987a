"""Report tables and pages. Tables are frames; a page collects only their first rows, which is what it shows."""

from __future__ import annotations

import html
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a table that a page shows.
SHOWN = 50


def summary(structures: DataFrame, jobs: DataFrame, state: str = "state") -> DataFrame:
    """name, n: structures and jobs by state, and both totals."""
    counted = lambda df, kind: df.groupBy(F.concat(F.lit(f"{kind}:"), F.col(state)).alias("name")).agg(F.count("*").alias("n"))
    total = lambda df, kind: df.agg(F.lit(kind).alias("name"), F.count("*").alias("n"))
    out = counted(structures, "structures").unionByName(counted(jobs, "jobs"))
    return out.unionByName(total(structures, "structures")).unionByName(total(jobs, "jobs"))


def history(tables: dict[str, DataFrame], key: str, value: object, seq: str) -> DataFrame:
    """source, seq, row (JSON) of everything known of one id, in order."""
    out = None
    for name, table in tables.items():
        one = table.filter(F.col(key) == value).select(F.lit(name).alias("source"), F.col(seq).cast("long").alias("seq"), F.to_json(F.struct("*")).alias("row"))
        out = one if out is None else out.unionByName(one)
    return out.orderBy("seq", "source")


@dataclass
class Page:
    """Sections of an HTML page, escaped, in order."""

    title: str
    sections: list[str] = field(default_factory=list)

    def table(self, heading: str, df: DataFrame, shown: int = SHOWN) -> Page:
        rows = df.limit(shown + 1).collect()
        cell = lambda v: "" if v is None else html.escape(f"{v:.4g}" if isinstance(v, float) else str(v))
        head = "".join(f"<th>{html.escape(c)}</th>" for c in df.columns)
        body = "".join("<tr>" + "".join(f"<td>{cell(v)}</td>" for v in row) + "</tr>" for row in rows[:shown])
        more = f"<p>First {shown} rows.</p>" if len(rows) > shown else ""
        self.sections.append(f"<h2>{html.escape(heading)}</h2><table><tr>{head}</tr>{body}</table>{more}")
        return self

    def hull(self, heading: str, points: DataFrame, lines: DataFrame, shown: int = 500) -> Page:
        """A drawing of binary entries (x, e_above_hull) and tie lines (x0, e0, x1, e1)."""
        p = points.select("x", "e").limit(shown).collect()
        seg = lines.filter("x1 is not null").select("x0", "e0", "x1", "e1").limit(shown).collect()
        values = [r.e for r in p] + [v for r in seg for v in (r.e0, r.e1)] or [0.0]
        low, span = min(values), (max(values) - min(values)) or 1.0
        at = lambda x, e: (20 + 360 * x, 180 - 160 * (e - low) / span)
        dots = "".join('<circle cx="{:.1f}" cy="{:.1f}" r="2"/>'.format(*at(r.x, r.e)) for r in p)
        ties = "".join('<line x1="{:.1f}" y1="{:.1f}" x2="{:.1f}" y2="{:.1f}" stroke="black"/>'.format(*at(r.x0, r.e0), *at(r.x1, r.e1)) for r in seg)
        self.sections.append(f'<h2>{html.escape(heading)}</h2><svg width="400" height="200">{ties}{dots}</svg>')
        return self

    def render(self) -> str:
        return f'<!DOCTYPE html><html><head><meta charset="utf-8"><title>{html.escape(self.title)}</title></head><body><h1>{html.escape(self.title)}</h1>{"".join(self.sections)}</body></html>'
