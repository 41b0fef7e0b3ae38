"""What numbered batches leave behind, merged as it grows.

Batch n writes a folder ``span=n-n``. Whenever ``fanout`` folders of one size
stand next to each other, they are merged into one that covers their numbers,
so a reader opens O(log n) folders however many batches there were. A folder
counts once its job is complete, and one that lies inside another doesn't count
any more: a merge that is cut short changes nothing, and what it merged goes
with the next write only, so readers that have listed it can finish.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lumenmart.operators import files

FANOUT = 8

Span = tuple[int, int]


class Spans:
    """Folders below ``root``; one writer at a time, whose batch numbers only grow or repeat."""

    def __init__(self, spark: SparkSession, root: str, fanout: int = FANOUT):
        self.spark, self.root, self.fanout = spark, root.rstrip("/"), fanout

    def path(self, span: Span) -> str:
        return f"{self.root}/span={span[0]}-{span[1]}"

    def _all(self) -> list[Span]:
        names = [n.removeprefix("span=").split("-") for n in files.children(self.spark, self.root) if n.startswith("span=")]
        return sorted((int(a), int(b)) for a, b in names)

    def current(self) -> list[Span]:
        """Complete spans that no other complete span covers, by number."""
        done = [s for s in self._all() if files.complete(self.spark, self.path(s))]
        return [s for s in done if not any(o != s and o[0] <= s[0] and s[1] <= o[1] for o in done)]

    def paths(self) -> list[str]:
        return [self.path(s) for s in self.current()]

    def put(self, number: int, write: Callable[[Span, str], None]) -> None:
        """``write`` a batch into its folder; a repeated batch that was merged already is there and is left alone."""
        self.sweep()
        if not any(a <= number <= b and a < b for a, b in self.current()):
            write((number, number), self.path((number, number)))

    def merge(self, write: Callable[[list[Span], Span, str], None]) -> None:
        """Merge neighbours of one size until there are fewer than ``fanout`` of each."""
        while group := self._mergeable():
            span = (group[0][0], group[-1][1])
            write(group, span, self.path(span))

    def _mergeable(self) -> list[Span] | None:
        current = self.current()
        for i in range(len(current) - self.fanout + 1):
            group = current[i : i + self.fanout]
            if len({self._level(s) for s in group}) == 1:
                return group
        return None

    def _level(self, span: Span) -> int:
        level, size = 0, self.fanout
        while span[1] - span[0] + 1 >= size:
            level, size = level + 1, size * self.fanout
        return level

    def sweep(self, drop: Callable[[Span], None] | None = None) -> None:
        """Remove what current spans cover and what cut-short writes left."""
        current = self.current()
        for s in self._all():
            if s not in current:
                if drop:
                    drop(s)
                files.drop(self.spark, self.path(s))

    def read(self) -> DataFrame:
        return self.spark.read.parquet(*self.paths())
