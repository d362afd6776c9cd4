"""Small tables with every awkward case, and plain computations to compare with."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
LONG = " ".join(f"word{i} the of" for i in range(20_000)) + "."
AWKWARD = [
    (1, "The quick brown fox jumps over the lazy dog tonight.", "en", "a", 1),
    (2, "The quick brown fox jumps over the lazy dog tonight.", "en", "a", 1),
    (2, "The quick brown fox jumps over the lazy dog tonight.", "en", "a", 1),
    (3, None, None, None, None),
    (4, "", "en", "a", 0),
    (5, " \t\n", "en", "a", 3),
    (None, "No id here, only words.", "en", "b", 4),
    (None, None, None, None, None),
    (6, LONG, "en", "b", 5),
    (7, LONG + " end", "en", "b", 5),
    (8, "one", "en", "b", 5),
    (9, "é ñ ß 漢字 \U0001f600 x\x85y\xa0z", "xx", "c", 5),
]
# Names that the operators use for columns of their own.
CLASHING = (
    "digest keep_id group_size kept class_id bands size key label component_id node score x shard "
    "template tokens at w host lines boiler piece length ids words chunk kind base found held_out"
).split()


def awkward(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    """The awkward documents with a null column for every clashing name."""
    docs = spark.createDataFrame(AWKWARD if rows is None else rows, DOCS)
    return docs.withColumns({c: F.lit(None).cast("string") for c in CLASHING if c not in docs.columns})


def rows_of(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


def shingles(text: str | None, n: int) -> set[tuple[bytes, ...]]:
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    n = min(n, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def near_groups(rows: list[tuple[int, str | None]], n: int, percent: int) -> dict[int, tuple[int, int]]:
    """doc_id -> (size of its set, smallest id reachable), comparing all pairs that share a shingle."""
    sets = [shingles(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    having = defaultdict(list)
    for j, own in enumerate(sets):
        common = defaultdict(int)
        for s in own:
            for i in having[s]:
                common[i] += 1
            having[s].append(j)
        for i, k in common.items():
            if 100 * k >= percent * (len(sets[i]) + len(own) - k):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    least: dict[int, int] = {}
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return {d: (len(sets[i]), least[root(i)]) for i, (d, _) in enumerate(rows)}
