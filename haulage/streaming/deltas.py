"""Tables kept as a base and numbered deltas, so that a micro-batch adds or looks up a part of them only.

    <path>/deltas/lote=<number>/balde=<bucket>/…     what one micro-batch adds
    <path>/base/lote=<number>/balde=<bucket>/…       everything up to that number, merged

A delta is written whole, replacing an earlier attempt of the same micro-batch, so it counts once however often the batch is tried. A
folder without its success mark is not there. `compact` writes a new base beside the old one and only then removes what no reader
needs: the base before the last one and the deltas in it. Rows are spread over buckets by a key column; a reader who knows the keys
reads their buckets and, by the statistics of the sorted files, their ranges.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulage.session import STORED

BUCKETS = 64
#: Ids that differ in these low bits only share a bucket, so a batch of neighbouring ids touches few.
NEAR_BITS = 12
#: Deltas after which a base is written anew.
MOST_DELTAS = 24


def bucket(near: Column, buckets: int = BUCKETS) -> Column:
    """The bucket of a BIGINT."""
    return F.pmod(F.xxhash64(F.shiftright(near, NEAR_BITS)), F.lit(buckets)).cast("int")


def _folder(spark: SparkSession, path: str):
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


@dataclass(frozen=True)
class Deltas:
    """`ddl` names the columns of a row; `sort` those by which files are sorted."""

    path: str
    ddl: str
    sort: Sequence[str]

    def numbers(self, spark: SparkSession, kind: str) -> list[int]:
        """Numbers of the complete folders of "deltas" or "base"."""
        system, place = _folder(spark, f"{self.path}/{kind}")
        if not system.exists(place):
            return []
        names = [f.getPath().getName() for f in system.listStatus(place)]
        done = [n for n in names if n.startswith("lote=") and system.exists(_folder(spark, f"{self.path}/{kind}/{n}/_SUCCESS")[1])]
        return sorted(int(n.removeprefix("lote=")) for n in done)

    def parts(self, spark: SparkSession, below: int | None = None) -> tuple[int | None, list[int]]:
        """The newest base and the deltas after it, of those with a number less than `below`."""
        known = [n for n in self.numbers(spark, "base") if below is None or n < below]
        base = max(known, default=None)
        return base, [n for n in self.numbers(spark, "deltas") if (below is None or n < below) and (base is None or n > base)]

    def write(self, rows: DataFrame, number: int, kind: str = "deltas") -> None:
        """`rows` (the columns of `ddl` and `balde`) as the delta of micro-batch `number`."""
        dealt = rows.repartition("balde").sortWithinPartitions("balde", *self.sort)
        dealt.write.mode("overwrite").partitionBy("balde").options(**STORED).parquet(f"{self.path}/{kind}/lote={number}")

    def read(self, spark: SparkSession, below: int | None = None, within: Column | None = None) -> DataFrame:
        """All rows, unmerged, with `balde` and `lote`, the number of the folder they are in. `within` selects rows, best by `balde`."""
        base, deltas = self.parts(spark, below)
        given, found = f"{self.ddl}, balde int, lote long", []
        for kind, numbers in (("base", [] if base is None else [base]), ("deltas", deltas)):
            if numbers:
                reader = spark.read.schema(given).option("basePath", f"{self.path}/{kind}")
                some = reader.parquet(*[f"{self.path}/{kind}/lote={n}" for n in numbers])
                found.append(some if within is None else some.where(within))
        return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], given)

    def compact(self, spark: SparkSession, below: int, merge: Callable[[DataFrame], DataFrame], most: int = MOST_DELTAS) -> bool:
        """With more than `most` deltas below `below`: `merge` of all rows becomes the base. `merge` keeps `ddl` and `balde`."""
        base, deltas = self.parts(spark, below)
        if len(deltas) <= most:
            return False
        self.write(merge(self.read(spark, below)), deltas[-1], "base")
        if base is not None:
            for kind, old in (("base", lambda n: n < base), ("deltas", lambda n: n <= base)):
                for number in filter(old, self.numbers(spark, kind)):
                    system, place = _folder(spark, f"{self.path}/{kind}/lote={number}")
                    system.delete(place, True)
        return True
