"""Size and null counts per partition, merged instead of recounted.

An upsert reads only the files it has just written for the profiles of the
partitions it touched; those of all other partitions are carried over from the
version before. The sums over the partitions bound broadcast decisions and answer
the not-null rules of the whole version, so no pass over the whole table is
needed. A profile is a handful of numbers per partition, kept as a small file in
the staged folder.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from medallion.operators.sizing import SizeProfile


@dataclass(frozen=True)
class PartProfiles:
    """``columns`` are profiled over the rows that the SQL condition ``where``
    holds for (default: all), NULLs of ``nulls`` over all rows. ``parts``: by
    partition key, {"all", "rows", "nulls": {column: n}, "bytes": {column: n}}."""

    columns: tuple[str, ...]
    nulls: tuple[str, ...] = ()
    where: str | None = None
    parts: dict = field(default_factory=dict)

    def _with(self, parts: dict) -> "PartProfiles":
        return PartProfiles(self.columns, self.nulls, self.where, parts)

    def without(self, parts: Iterable[str]) -> "PartProfiles":
        gone = set(parts)
        return self._with({k: v for k, v in self.parts.items() if k not in gone})

    def merged(self, other: "PartProfiles") -> "PartProfiles":
        return self._with({**self.parts, **other.parts})

    def total(self) -> SizeProfile:
        """The size profile of the whole version."""
        size: dict[str, int] = {}
        for p in self.parts.values():
            for c, n in p["bytes"].items():
                size[c] = size.get(c, 0) + n
        return SizeProfile(sum(p["rows"] for p in self.parts.values()), size, list(self.columns))

    def all_rows(self) -> int:
        return sum(p["all"] for p in self.parts.values())

    def null_count(self, column: str) -> int:
        return sum(p["nulls"][column] for p in self.parts.values())

    def dump(self) -> str:
        return json.dumps({"columns": self.columns, "nulls": self.nulls, "where": self.where, "parts": self.parts})

    def load(self, text: str) -> "PartProfiles | None":
        """The stored profiles, if they are of the same columns and rows."""
        body = json.loads(text)
        same = (tuple(body["columns"]), tuple(body["nulls"]), body["where"]) == (self.columns, self.nulls, self.where)
        return self._with(body["parts"]) if same else None


def profile_parts(frame: DataFrame, part: Column, spec: PartProfiles) -> PartProfiles:
    """Profiles of the partitions of ``frame``: one grouped pass over the
    profiled columns, one row per partition to the driver."""
    counted = F.coalesce(F.expr(spec.where), F.lit(False)) if spec.where else F.lit(True)
    variable = [f.name for f in frame.schema.fields if f.name in spec.columns and isinstance(f.dataType, (StringType, BinaryType))]
    sizes = [
        F.sum(F.when(counted, F.coalesce(F.octet_length(F.col(c)), F.lit(0))).otherwise(0)).alias(f"_b{i}")
        for i, c in enumerate(variable)
    ]
    nulls = [F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(spec.nulls)]
    rows = frame.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_all"), F.count_if(counted).alias("_rows"), *sizes, *nulls)
    return spec._with({
        r["_part"]: {
            "all": r["_all"], "rows": r["_rows"], "nulls": {c: r[f"_n{i}"] for i, c in enumerate(spec.nulls)},
            "bytes": {c: r[f"_b{i}"] for i, c in enumerate(variable)},
        }
        for r in rows.collect()
    })


def null_results(profiles: PartProfiles, rules: Sequence, dataset: str) -> list[dict]:
    """Result rows of not-null rules over the whole version."""
    return [
        {
            "dataset": dataset, "rule": r.name, "column": r.column, "element_count": profiles.all_rows(),
            "unexpected_count": profiles.null_count(r.column), "success": profiles.null_count(r.column) == 0,
        }
        for r in rules
        if r.kind == "not_null"
    ]
