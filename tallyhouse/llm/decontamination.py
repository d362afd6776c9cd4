"""Benchmark questions found in documents, also with other numbers, names and units.

A text is cut into tokens: numbers, words, and marks that end a sentence. Each token becomes one of a
template: a number is ``<number>``, a unit right after a number ``<unit>``, a run of words with a
capital that do not begin a sentence one ``<name>``, any other word itself in lower case. Windows of ``WINDOW``
template tokens, of which at least ``LEAST_PLAIN`` are plain words, are joined by hash with those of
the benchmark. A document leaks an item if the distinct windows of the item that it contains are at
least ``PERCENT`` per cent of the item's windows, counting only windows with consistent slots: along
one alignment of item and document, every value of the item stands for one value of the document
and the other way round. So a question asked again with other values is found, and a text that
merely has the same shape is not.

A second set of windows is free of case: there a word is itself in lower case, capital or not, so that
a copy in other letter case is found too. A document leaks an item if either set reaches the bound;
the counts are those of the first set if it does. It also leaks an item, whatever share that is, if
``RUN`` windows that follow each other in the item match along one alignment with consistent slots;
the counts are then those of the windows in such runs. An item in which no window has enough plain
words is one window as a whole: its raw tokens in lower case, without end marks.

Everything is a DataFrame expression. Documents make windows within a row; the hash join is a
broadcast of the benchmark's windows if they are few, which is checked, and a shuffle otherwise. A
window without ``<name>`` is the same in both sets and made once.
Slots are looked at only for documents and items that have enough windows. No text is shuffled but
that of those documents, if they are too many to be sent as ids.

Defined results: null and empty texts leak nothing; an item with fewer than ``LEAST_WHOLE`` tokens
cannot be found; every row is judged by its own text, whether or not others have its ``doc_id`` or it
has none, and rows alike in both share one result; items with the same or no id are one; ties for the best
item go to the smallest id; empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import with_ids
from tallyhouse.storage import stage

WINDOW = 5
LEAST_PLAIN = 3
PERCENT = 80
# Windows of a run that is a leak by itself: 30 tokens.
RUN = 26
# Tokens of an item that is compared as a whole.
LEAST_WHOLE = 3
# Most benchmark windows that are sent to every executor (about 24 bytes each).
BROADCAST_WINDOWS = 2_000_000

# What a token is, and the words that are units after a number.
TOKEN = r"[0-9]+(?:[.,][0-9]+)*|[\p{L}\p{M}]+|[.!?\n]"
UNITS = (
    "mm cm dm m km in ft yd mi mg g kg t lb lbs oz ml cl dl l gal s sec min h hr hrs hz khz mhz ghz "
    "w kw mw v kv a ma j kj kcal cal n pa kpa bar k c f b kb mb gb tb eur usd gbp "
    "meter meters metre metres kilometer kilometers inch inches foot feet yard yards mile miles "
    "gram grams kilogram kilograms pound pounds ounce ounces ton tons liter liters litre litres "
    "second seconds minute minutes hour hours day days week weeks month months year years "
    "dollar dollars euro euros cent cents percent degree degrees"
).split()

NUMBER, UNIT, NAME = "<number>", "<unit>", "<name>"
# The sets of windows, as bits: with names as slots, and free of case.
NAMED, FREE = 1, 2
# What a code stands for: a word, a number or unit, a name as a slot, the word of a name.
PLAIN, SLOT, NAME_SLOT, NAME_WORD = 0, 1, 2, 3


def tokens_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({TOKEN})"), F.lit(1))


def _is_number(token: Column) -> Column:
    return F.substring(token, 1, 1).between("0", "9")


def _is_end(token: Column) -> Column:
    return token.isin(".", "!", "?", "\n")


def mark_of(tokens: Column, token: Column, at: Column, values: bool) -> Column:
    """The template token of one token, given all tokens and its place; null for an end mark. A name
    carries its word and ``|``; with ``values`` numbers and units carry theirs."""
    before, word = F.get(tokens, at - 1), F.lower(token)
    return (
        F.when(_is_end(token), F.lit(None).cast("string"))
        .when(_is_number(token), F.concat(F.lit(NUMBER), token) if values else F.lit(NUMBER))
        .when(
            (at > 0) & _is_number(before) & word.isin(UNITS),
            F.concat(F.lit(UNIT), word) if values else F.lit(UNIT),
        )
        .when((at > 0) & ~_is_end(before) & (word != token), F.concat(F.lit(NAME), word, F.lit("|")))
        .otherwise(word)
    )


def marks(tokens: Column, values: bool = False) -> Column:
    """The marks of a token column, without end marks."""
    return F.filter(
        F.transform(tokens, lambda x, i: mark_of(tokens, x, i, values)), lambda x: x.isNotNull()
    )


def _collapsed(of: Column) -> Column:
    """Marks with neighbouring names as one."""
    joined = F.replace(F.array_join(of, " "), F.lit(f"| {NAME}"), F.lit("_"))
    return F.filter(F.split(joined, " "), lambda x: x != "")


def _free(of: Column) -> Column:
    """Marks with names as the words that they are."""
    return F.transform(
        of, lambda x: F.when(x.startswith(NAME), F.regexp_extract(x, r"^<name>(.*)\|$", 1)).otherwise(x)
    )


def _zipped(of: Column) -> Column:
    """Every window of an array, as a struct of its parts: the shifted arrays are zipped, so a row
    holds five tokens and never the whole text."""
    n = F.greatest(F.size(of) - F.lit(WINDOW - 1), F.lit(0))
    names = [f"t{k}" for k in range(WINDOW)]
    slices = [F.slice(of, k + 1, n) for k in range(WINDOW)]
    return F.arrays_zip(*slices).cast("array<struct<" + ",".join(f"{x}:string" for x in names) + ">>")


def _enough(parts: list[Column]) -> Column:
    return sum((~p.startswith("<")).cast("int") for p in parts) >= LEAST_PLAIN


def _code(token: Column, kind: int) -> Column:
    """A hash of a template token whose last two bits say what it is."""
    return F.xxhash64(token).bitwiseAND(F.lit(~3)).bitwiseOR(F.lit(kind))


def codes(tokens: Column) -> Column:
    """The marks of a token column as codes, without end marks; a name is the code of its word."""

    def code(token: Column, at: Column) -> Column:
        before, word = F.get(tokens, at - 1), F.lower(token)
        return (
            F.when(_is_end(token), F.lit(None).cast("bigint"))
            .when(_is_number(token), _code(F.lit(NUMBER), SLOT))
            .when((at > 0) & _is_number(before) & word.isin(UNITS), _code(F.lit(UNIT), SLOT))
            .when((word != token) & (at > 0) & ~_is_end(before), _code(word, NAME_WORD))
            .otherwise(_code(word, PLAIN))
        )

    return F.filter(F.transform(tokens, code), lambda x: x.isNotNull())


def _kind(code: Column) -> Column:
    return code.bitwiseAND(F.lit(3))


def _collapsed_codes(of: Column) -> Column:
    """Codes with names as slots and neighbouring names as one."""
    first = F.filter(
        of, lambda x, i: (_kind(x) != NAME_WORD) | (i == 0) | (_kind(F.get(of, i - 1)) != NAME_WORD)
    )
    return F.transform(first, lambda x: F.when(_kind(x) == NAME_WORD, _code(F.lit(NAME), NAME_SLOT)).otherwise(x))


def _code_windows(of: Column) -> Column:
    n = F.greatest(F.size(of) - F.lit(WINDOW - 1), F.lit(0))
    return F.arrays_zip(*(F.slice(of, k + 1, n) for k in range(WINDOW)))


def _windows(rows: DataFrame, keep: list[str]) -> DataFrame:
    """(*keep, key, sets): hash of every window with enough plain words of the rows' texts, and the
    sets that it is in. Tokens are hashed once for each text; a window is made of five numbers."""
    rows = rows.select(*keep, tokens_of(F.col("text")).alias("tokens"))
    rows = rows.select(*keep, codes(F.col("tokens")).alias("codes"))
    of = F.col("codes")
    named = F.exists(of, lambda x: _kind(x) == NAME_WORD)
    free = F.filter(
        _code_windows(of),
        lambda w: sum((_kind(w[str(k)]) == NAME_WORD).cast("int") for k in range(WINDOW)) > 0,
    )
    both = F.when(named, F.concat(_code_windows(_collapsed_codes(of)), free)).otherwise(_code_windows(of))
    parts = [F.col("w").getField(str(k)) for k in range(WINDOW)]

    def holds(*kinds: int) -> Column:
        return sum(_kind(p).isin(*kinds).cast("int") for p in parts)

    # The word of a name is a plain word in the set that is free of case.
    return (
        rows.select(*keep, F.explode(both).alias("w"))
        .where(holds(PLAIN, NAME_WORD) >= LEAST_PLAIN)
        .select(
            *keep,
            F.xxhash64(*(p.bitwiseAND(F.lit(~3)) for p in parts)).alias("key"),
            F.when(holds(NAME_WORD) > 0, FREE)
            .when(holds(NAME_SLOT) > 0, NAMED)
            .otherwise(NAMED | FREE)
            .alias("sets"),
        )
    )


def _per_set(found: DataFrame) -> DataFrame:
    """A row for each set of a window."""
    sets = F.array(F.lit(NAMED), F.lit(FREE))
    return found.withColumn("of_set", F.explode(F.filter(sets, lambda x: x.bitwiseAND(F.col("sets")) > 0))).drop("sets")


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, of_set, key, n_at, n_windows), stored: the distinct windows of every item, at how many
    places they are, and their number."""
    found = _per_set(_windows(benchmark, ["item_id"])).groupBy("item_id", "of_set", "key")
    found = stage(found.agg(F.count("*").alias("n_at")), "item-windows")
    counts = found.groupBy(F.col("item_id").alias("i_"), F.col("of_set").alias("s_")).agg(
        F.count("*").alias("n_windows")
    )
    found = found.join(counts, F.col("item_id").eqNullSafe(F.col("i_")) & (F.col("of_set") == F.col("s_")))
    return stage(found.select("item_id", "of_set", "key", "n_at", "n_windows"), "benchmark-windows")


def _small(windows: DataFrame) -> DataFrame:
    return F.broadcast(windows) if windows.count() <= BROADCAST_WINDOWS else windows


def candidates(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(doc_id, item_id, of_set) that share enough windows, whatever the slots hold; stored."""
    found = (
        _windows(docs, ["doc_id"])
        .join(_small(windows), "key")
        .where(F.col("of_set").bitwiseAND(F.col("sets")) > 0)
        .groupBy("doc_id", "item_id", "of_set", "n_windows", "key")
        .agg(F.first("n_at").alias("n_at"))
        .groupBy("doc_id", "item_id", "of_set", "n_windows")
        .agg(F.count("*").alias("n"), F.sum("n_at").alias("n_places"))
        .where((100 * F.col("n") >= PERCENT * F.col("n_windows")) | (F.col("n_places") >= RUN))
    )
    return stage(found.select("doc_id", "item_id", "of_set"), "leak-candidates")


def _slots(rows: DataFrame, name: str) -> DataFrame:
    """(name, of_set, at, key, slots) of the windows of both sets: the slots are the marks that stand
    for a number, unit or name, with its value."""
    rows = rows.select(name, tokens_of(F.col("text")).alias("tokens"))
    rows = rows.select(name, marks(F.col("tokens"), values=True).alias("marks"))
    named = rows.select(name, F.lit(NAMED).alias("of_set"), F.posexplode(_zipped(_collapsed(F.col("marks")))).alias("at", "w"))
    free = rows.select(
        name, F.lit(FREE).alias("of_set"), F.posexplode(_zipped(_free(F.col("marks")))).alias("at", "w")
    )
    parts = [F.col(f"w.t{k}") for k in range(WINDOW)]
    bare = [F.when(p.startswith("<"), F.regexp_extract(p, "^<[a-z]+>", 0)).otherwise(p) for p in parts]
    slots = F.array(*(F.when(p.startswith("<"), p) for p in parts))
    return (
        named.unionByName(free)
        .where(_enough(parts))
        .select(name, "of_set", "at", F.xxhash64(*bare).alias("key"), slots.alias("slots"))
    )


def _runs(matches: DataFrame) -> DataFrame:
    """(doc_id, item_id, of_set, n_windows, n_matched) of pairs with a run of consistent windows."""
    line = Window.partitionBy("doc_id", "item_id", "of_set", "shift").orderBy("place").rangeBetween(0, RUN - 1)
    filled = F.filter(F.arrays_zip("item_slots", "doc_slots"), lambda v: v["item_slots"].isNotNull())
    rows = matches.withColumn("filled", filled).select(
        "doc_id", "item_id", "of_set", "n_windows",
        F.size(F.collect_set("place").over(line)).alias("n"),
        F.collect_set("key").over(line).alias("keys"),
        F.array_distinct(F.flatten(F.collect_list("filled").over(line))).alias("values"),
    )
    n = F.size("values")
    rows = rows.where(
        (F.col("n") == RUN)
        & (n == F.size(F.array_distinct("values.item_slots")))
        & (n == F.size(F.array_distinct("values.doc_slots")))
    )
    pair = ["doc_id", "item_id", "of_set", "n_windows"]
    return rows.select(*pair, F.explode("keys").alias("key")).groupBy(*pair).agg(
        F.countDistinct("key").alias("n_matched")
    )


def _whole_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame | None:
    """(doc_id, item_id) of items without a usable window whose tokens stand in a document one after
    the other; None without such items."""
    raw = F.transform(F.filter("tokens", lambda x: ~_is_end(x)), F.lower)
    items = benchmark.select("item_id", tokens_of(F.col("text")).alias("tokens"))
    usable = F.exists(
        _zipped(_free(marks(F.col("tokens")))), lambda w: _enough([w[f"t{k}"] for k in range(WINDOW)])
    )
    items = items.where(~usable).select("item_id", raw.alias("raw")).where(F.size("raw") >= LEAST_WHOLE)
    items = items.select("item_id", F.size("raw").alias("n"), F.xxhash64("raw").alias("key"))
    items = stage(items.distinct(), "whole-items")
    lengths = sorted(r.n for r in items.select("n").distinct().collect())
    if not lengths:
        return None
    rows = docs.select("doc_id", tokens_of(F.col("text")).alias("tokens")).select("doc_id", raw.alias("raw"))
    rows = rows.withColumn("n", F.explode(F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.size("raw"))))
    starts = F.sequence(F.lit(1), F.size("raw") - F.col("n") + 1)
    keys = F.transform(starts, lambda k: F.xxhash64(F.slice("raw", k, F.col("n"))))
    rows = rows.select("doc_id", "n", F.explode(F.array_distinct(keys)).alias("key"))
    return rows.join(_small(items), ["n", "key"]).select("doc_id", "item_id").distinct()


def row_key() -> Column:
    """What names a row: ids may be missing or repeated, and each text is judged on its own."""
    return F.xxhash64("doc_id", "text")


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_matched, n_windows) of every item that a row leaks."""
    found = stage(row_leaks(docs, benchmark), "row-leaks").withColumnRenamed("doc_id", "r_")
    rows = docs.select("doc_id", row_key().alias("k_"))
    return rows.join(found, F.col("k_") == F.col("r_")).select("doc_id", "item_id", "n_matched", "n_windows")


def row_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The same with the ``row_key`` of the row as ``doc_id``."""
    docs = docs.select(row_key().alias("doc_id"), "text")
    windows = benchmark_windows(benchmark)
    pairs = candidates(docs, windows)
    known = with_ids(docs, pairs, "doc_id")
    # Rows alike in id and text are judged once.
    known = known.dropDuplicates(["doc_id"])
    d = _slots(known, "doc_id").withColumnsRenamed({"at": "doc_at", "slots": "doc_slots"})
    i = _slots(benchmark.select("item_id", "text"), "item_id")
    i = i.withColumnsRenamed({"at": "item_at", "slots": "item_slots"})
    places = Window.partitionBy("item_id", "of_set").orderBy("item_at")
    i = i.withColumn("place", F.dense_rank().over(places))
    sizes = windows.select(F.col("item_id").alias("of_"), F.col("of_set").alias("s_"), "n_windows").distinct()
    wanted = pairs.toDF("d_", "i_", "set_").join(
        sizes, F.col("i_").eqNullSafe(F.col("of_")) & (F.col("set_") == F.col("s_"))
    ).drop("of_", "s_")
    matches = d.join(i, ["of_set", "key"]).join(
        wanted,
        F.col("doc_id").eqNullSafe(F.col("d_"))
        & F.col("item_id").eqNullSafe(F.col("i_"))
        & (F.col("of_set") == F.col("set_")),
    )
    matches = matches.withColumn("shift", F.col("doc_at") - F.col("item_at"))
    matches = stage(matches.drop("d_", "i_", "set_", "doc_at"), "window-matches")

    line = ["doc_id", "item_id", "of_set", "shift"]
    values = matches.select(*line, F.explode(F.arrays_zip("item_slots", "doc_slots")).alias("v"))
    values = values.where("v.item_slots IS NOT NULL").select(
        *line, F.col("v.item_slots").alias("asked"), F.col("v.doc_slots").alias("found")
    )
    values = values.distinct()
    twice = (
        values.groupBy(*line, "asked").count().where("count > 1").select(*line)
        .union(values.groupBy(*line, "found").count().where("count > 1").select(*line))
        .distinct()
        .toDF("d_", "i_", "set_", "s_")
    )
    consistent = matches.join(
        twice,
        F.col("doc_id").eqNullSafe(F.col("d_"))
        & F.col("item_id").eqNullSafe(F.col("i_"))
        & (F.col("of_set") == F.col("set_"))
        & (F.col("shift") == F.col("s_")),
        "left_anti",
    )
    found = (
        consistent.groupBy("doc_id", "item_id", "of_set", "n_windows")
        .agg(F.countDistinct("key").alias("n_matched"))
        .where(100 * F.col("n_matched") >= PERCENT * F.col("n_windows"))
    )
    found = found.withColumn("way", F.lit(0)).unionByName(_runs(matches).withColumn("way", F.lit(1)))
    whole = _whole_items(docs, benchmark)
    if whole is not None:
        one = F.lit(1).cast("bigint")
        whole = whole.withColumns({"of_set": F.lit(0), "n_windows": one, "n_matched": one, "way": F.lit(2)})
        found = found.unionByName(whole)
    best = F.min(F.struct("way", "of_set", "n_matched", "n_windows")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "best.n_matched", "best.n_windows"
    )


def leak_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, n_leaked, item_id, n_matched, n_windows) of every row of ``docs``: how many items it
    leaks, and of the one with the most windows its id and counts; null without any."""
    best = row_leaks(docs, benchmark).groupBy("doc_id").agg(
        F.count("*").alias("n_leaked"),
        F.min(F.struct(-F.col("n_matched"), "item_id", "n_windows")).alias("best"),
    )
    best = stage(best, "leaking-documents").withColumnRenamed("doc_id", "d_")
    return docs.select("doc_id", row_key().alias("r_")).join(best, F.col("r_") == F.col("d_"), "left").select(
        "doc_id",
        F.coalesce("n_leaked", F.lit(0).cast("bigint")).alias("n_leaked"),
        F.col("best.item_id").alias("item_id"),
        (-F.col("best.col1")).alias("n_matched"),
        F.col("best.n_windows").alias("n_windows"),
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with its own columns and without the rows that leak an item."""
    found = row_leaks(docs, benchmark).select(F.col("doc_id").alias("leaking_row_"))
    found = stage(found.distinct(), "leaking-rows")
    return docs.join(found, row_key() == F.col("leaking_row_"), "left_anti")


def sql() -> str:
    """The same question for DuckDB, on whole windows instead of hashes."""
    units = ", ".join(f"'{u}'" for u in UNITS)
    places = range(1, WINDOW + 1)
    typed = f"('{NUMBER}', '{UNIT}', '{NAME}')"

    def side(table: str, name: str) -> str:
        plain = " + ".join(f"(w[{k}].t NOT IN {typed})::INT" for k in places)
        key = ", ".join(f"w[{k}].t" for k in places)
        slots = ", ".join(
            f"CASE WHEN w[{k}].t IN {typed} THEN concat(w[{k}].t, lower(w[{k}].x)) END" for k in places
        )
        return rf"""
            SELECT {name}, pos, [{key}] AS key, [{slots}] AS slots
            FROM (
                SELECT {name}, pos, list_slice(b, pos, pos + {WINDOW - 1}) AS w
                FROM (SELECT {name}, b, unnest(range(1, greatest(len(b) - {WINDOW - 2}, 1))) AS pos
                FROM (
                    SELECT {name}, list_filter(list_transform(tk, lambda x, i: {{'x': x, 't':
                        CASE WHEN x IN ('.', '!', '?', chr(10)) THEN NULL
                             WHEN x[1] BETWEEN '0' AND '9' THEN '{NUMBER}'
                             WHEN i > 1 AND tk[i - 1][1] BETWEEN '0' AND '9' AND lower(x) IN ({units}) THEN '{UNIT}'
                             WHEN i > 1 AND tk[i - 1] NOT IN ('.', '!', '?', chr(10)) AND lower(x) <> x THEN '{NAME}'
                             ELSE lower(x) END}}), lambda s: s.t IS NOT NULL) AS b
                    FROM (
                        SELECT {name}, regexp_extract_all(coalesce(text, ''), '{TOKEN}') AS tk FROM {table}
                    )
                ))
            )
            WHERE {plain} >= {LEAST_PLAIN}"""

    return rf"""
        WITH d AS ({side('documents', 'doc_id')}),
        i AS ({side('benchmark', 'item_id')}),
        sized AS (SELECT item_id, count(DISTINCT key) AS n_windows FROM i GROUP BY item_id),
        m AS (
            SELECT doc_id, item_id, d.pos - i.pos AS shift, key, i.slots AS asked, d.slots AS found
            FROM d JOIN i USING (key)
        ),
        pair AS (
            SELECT doc_id, item_id FROM m JOIN sized USING (item_id)
            GROUP BY doc_id, item_id, n_windows HAVING 100 * count(DISTINCT key) >= {PERCENT} * n_windows
        ),
        v AS (
            SELECT DISTINCT doc_id, item_id, shift, a, f
            FROM (
                SELECT doc_id, item_id, shift, unnest(asked) AS a, unnest(found) AS f
                FROM m SEMI JOIN pair USING (doc_id, item_id)
            ) WHERE a IS NOT NULL
        ),
        twice AS (
            SELECT doc_id, item_id, shift FROM v GROUP BY doc_id, item_id, shift, a HAVING count(*) > 1
            UNION
            SELECT doc_id, item_id, shift FROM v GROUP BY doc_id, item_id, shift, f HAVING count(*) > 1
        ),
        leak AS (
            SELECT doc_id, item_id, n_windows, count(DISTINCT key) AS n_matched
            FROM (SELECT * FROM m SEMI JOIN pair USING (doc_id, item_id)) ANTI JOIN twice USING (doc_id, item_id, shift)
            JOIN sized USING (item_id)
            GROUP BY doc_id, item_id, n_windows
            HAVING 100 * count(DISTINCT key) >= {PERCENT} * n_windows
        ),
        best AS (
            SELECT doc_id, count(*) AS n_leaked, min((-n_matched, item_id, n_windows)) AS best FROM leak GROUP BY doc_id
        )
        SELECT doc_id, coalesce(n_leaked, 0) AS n_leaked, best[2] AS item_id, -best[1] AS n_matched,
               best[3] AS n_windows
        FROM documents LEFT JOIN best USING (doc_id)
    """
