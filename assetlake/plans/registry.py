"""Registration of queries together with their oracle SQL and a shared output form."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlake.plans.views import Tables, oracle_text

TIME_FORMAT_SPARK = "yyyy-MM-dd HH:mm:ss.SSSSSS"
TIME_FORMAT_ORACLE = "%Y-%m-%d %H:%M:%S.%f"


@dataclass(frozen=True)
class Query:
    """A registered query; floats are rounded and times printed alike on both sides."""

    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None
    floats: tuple[str, ...]
    times: tuple[str, ...]
    dates: tuple[str, ...]
    scale: int

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        out = self.build(Tables(spark, sf_dir))
        changes = {c: F.round(F.col(c).cast("double"), self.scale) + F.lit(0.0) for c in self.floats}
        zoned = {c for c, kind in out.dtypes if kind == "timestamp"}  # instants are printed in UTC
        for c in self.times:
            moment = F.to_utc_timestamp(F.col(c), F.current_timezone()) if c in zoned else F.col(c)
            changes[c] = F.date_format(moment, TIME_FORMAT_SPARK)
        changes |= {c: F.date_format(F.col(c), "yyyy-MM-dd") for c in self.dates}
        return out.withColumns(changes) if changes else out

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        changes = [f"round(CAST({c} AS DOUBLE), {self.scale}) + 0.0 AS {c}" for c in self.floats]
        changes += [f"strftime({c}, '{TIME_FORMAT_ORACLE}') AS {c}" for c in self.times]
        changes += [f"strftime({c}, '%Y-%m-%d') AS {c}" for c in self.dates]
        if not changes:
            return oracle_text(self.sql)
        text = oracle_text(self.sql)
        return f"SELECT * REPLACE ({', '.join(changes)}) FROM (\n{text}\n) q"


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, floats: str = "", times: str = "", dates: str = "", scale: int = 6):
    """Register a function of the tables under ``name``."""

    def wrap(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in REGISTRY:
            raise ValueError(f"duplicate query: {name}")
        REGISTRY[name] = Query(
            name, build, sql, tuple(floats.split()), tuple(times.split()), tuple(dates.split()), scale
        )
        return build

    return wrap
