"""The keys of a stored table, found without reading the table.

Every load leaves the keys that it added as one span: files by bucket, which is
the leading bits of the key's hash, and a Bloom filter for them. The filter is
made of blocks of 4 KB; a key sets `HASHES` bits in the block that the leading
bits of its hash name, and the next bits within a block are hashes of their own.
A batch asks the filters, of some two bytes a key, which buckets may hold one
of its keys, and only their files are opened. New keys are
let through to a bucket now and then (below one in a thousand), known keys
always, so what is found is exact.

Spans are merged as in `Spans`. Parquet keeps the index below `_keys` in the
table's folder, which Spark's readers skip.
"""

from __future__ import annotations

from functools import reduce
from math import ceil, log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenmart.operators import files
from lumenmart.operators.spans import Span, Spans

#: Bits of a filter per key, bits that a key sets, bits of a block, keys of a bucket.
BITS_PER_KEY, HASHES, BLOCK, BUCKET_KEYS = 16, 6, 1 << 15, 1 << 20


def _hash(key: Column) -> Column:
    return F.xxhash64(key)


def _positions(h: Column) -> list[Column]:
    """Bits that a key sets in its block, from 0."""
    return [F.pmod(F.xxhash64(h, F.lit(j)), F.lit(BLOCK)).cast("bigint") for j in range(HASHES)]


def _all_set(bits: Column, positions: list[Column]) -> Column:
    def is_set(position: Column) -> Column:
        byte = F.conv(F.hex(F.substring(bits, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.bit_get(byte, (position % 8).cast("int")) == 1

    return reduce(lambda x, y: x & y, map(is_set, positions))


class KeyIndex:
    def __init__(self, spark: SparkSession, table: str, key: str, bucket_keys: int = BUCKET_KEYS):
        self.spark, self.key, self.bucket_keys = spark, key, bucket_keys
        self.root = f"{table.rstrip('/')}/_keys"
        self.spans = Spans(spark, f"{self.root}/filters")

    def exists(self) -> bool:
        return bool(self.spans.current())

    def _ids(self, span: Span) -> str:
        return f"{self.root}/ids/span={span[0]}-{span[1]}"

    def _write(self, keys: DataFrame, n: int, span: Span, path: str) -> None:
        """Keys by bucket, then the filter; the span counts once the filter is complete."""
        keys = keys.select(F.col(self.key).alias("key")).where("key is not null")
        blocks = max(1, ceil(log2(max(n * BITS_PER_KEY / BLOCK, 1))))
        buckets = min(blocks, max(0, ceil(log2(max(n / self.bucket_keys, 1)))))
        block = F.shiftrightunsigned(_hash(F.col("key")), 64 - blocks)
        placed = keys.withColumn("bucket", F.shiftrightunsigned(block, blocks - buckets))
        placed.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(self._ids(span))
        stored = self.spark.read.schema(placed.schema).parquet(self._ids(span))
        each = stored.withColumn("h", _hash(F.col("key"))).withColumn("block", F.shiftrightunsigned("h", 64 - blocks))
        bits = each.select("bucket", "block", F.explode(F.array(*_positions(F.col("h")))).alias("position")).groupBy("bucket", "block")
        rows = bits.agg(F.bitmap_construct_agg("position").alias("bits"))
        # the shape stands in the folders' names, where the driver finds it without a job
        shaped = rows.select("*", F.lit(blocks).alias("l"), F.lit(buckets).alias("b"))
        shaped.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("l", "b").parquet(path)

    def add(self, keys: DataFrame, n: int | None = None) -> None:
        """Note keys as stored; keys that are noted already do no harm. `n` is their number, if known."""
        n = keys.count() if n is None else n
        self.spans.sweep(lambda s: files.drop(self.spark, self._ids(s)))
        number = max((b for _, b in self.spans.current()), default=-1) + 1
        self.spans.put(number, lambda span, path: self._write(keys, n, span, path))

        def merge(group: list[Span], span: Span, path: str) -> None:
            together = self._read(group)
            self._write(together, together.count(), span, path)

        self.spans.merge(merge)

    def _keys(self, folders: list[str]) -> DataFrame:
        return self.spark.read.option("basePath", f"{self.root}/ids").parquet(*folders).select(F.col("key").alias(self.key))

    def _read(self, spans: list[Span]) -> DataFrame:
        return self._keys([self._ids(s) for s in spans])

    def buckets(self, keys: DataFrame) -> list[str]:
        """Folders that may hold one of the keys; there are as many as the index has buckets at most."""
        shapes = {f"{a}-{b}": ((a, b), *shape) for a, b in self.spans.current() if (shape := self._shape((a, b)))}
        if not shapes:
            return []
        filters = self.spark.read.option("basePath", self.spans.root).parquet(*(self.spans.path(s) for s, _, _ in shapes.values()))
        spans = F.array(*(F.struct(F.lit(name).alias("span"), F.lit(l).alias("l")) for name, (_, l, _) in shapes.items()))
        asked = keys.where(F.col(self.key).isNotNull()).select(_hash(F.col(self.key)).alias("h")).distinct()
        asked = asked.select("h", F.inline(spans)).withColumn("block", F.expr("shiftrightunsigned(h, 64 - l)")).drop("l")
        met = asked.join(filters.select("span", "bucket", "block", "bits"), ["span", "block"])
        found = met.where(_all_set(F.col("bits"), _positions(F.col("h")))).select("span", "bucket").distinct()
        return sorted(f"{self._ids(shapes[r.span][0])}/bucket={r.bucket}" for r in found.collect())

    def _shape(self, span: Span) -> tuple[int, int] | None:
        """Leading bits that name a block and a bucket of a span; None for one without keys."""
        path, out = self.spans.path(span), []
        for name in ("l", "b"):
            folder = next((f for f in files.children(self.spark, path) if f.startswith(f"{name}=")), None)
            if folder is None:
                return None
            out.append(int(folder.split("=")[1]))
            path = f"{path}/{folder}"
        return out[0], out[1]

    def holding(self, keys: DataFrame) -> DataFrame:
        """The keys that are stored, read from the buckets that may hold them."""
        folders = self.buckets(keys)
        if not folders:
            return keys.select(self.key).where("false")
        return self._keys(folders).join(keys.select(self.key), self.key, "left_semi")
