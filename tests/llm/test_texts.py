from __future__ import annotations

import base64
import contextlib
import gzip
import hashlib
import io
import json
import tarfile
import urllib.parse
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyhouse.llm import decontamination, line_dedup, packing, queries, secret_scan, warc
from tallyhouse.storage import fresh_path, stage

from tests.compare import difference, duck
from tests.llm.cases import AWKWARD, awkward, rows_of

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, name):
    got = queries.QUERIES[name](spark, SF_DIR).toArrow()
    assert difference(got, duck(SF_DIR).sql(queries.SQL[name]).to_arrow_table()) is None


# Packing -----------------------------------------------------------------------------------------

WEIRD = ["a b\x1cc", "<|endoftext|> x<|startoftext|>y", "ſ KK Σας ΣΑΣ", "é ́x ñ́", "it's we'll 'S a12b３ 4.5", "\xa0​᠎ x\x85y\xa0", "", " ", "I'M don'T!!", "İstanbul end.,", "word*** !x"]


def plain_ids(text: str) -> bytes:
    from tokenizers import Tokenizer

    ids = Tokenizer.from_file(queries.tokenizer_path()).encode(text, add_special_tokens=False).ids
    return np.array(ids, dtype="<u4").tobytes()


@pytest.mark.parametrize("text", WEIRD)
def test_ids_equal_the_tokenizer(text):
    assert packing.Ids(queries.tokenizer_path()).of([text, "x"])[0] == plain_ids(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aA .,'!Σσς\t\n\x1dé́ﬁ1٣$ß漢"), max_size=12), max_size=4))
def test_ids_of_any_text(texts):
    encoder = packing.ids_of(queries.tokenizer_path())
    assert encoder.of(texts) == [plain_ids(t) for t in texts]


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED_WORDS", 10)
    encoder = packing.Ids(queries.tokenizer_path())
    for start in range(0, 100, 7):
        text = " ".join(f"word{chr(97 + i % 26)}{i}" for i in range(start, start + 7))
        assert encoder.of([text])[0] == plain_ids(text)
        assert len(encoder.words) <= 40


def test_each_word_is_encoded_once_and_kept_by_place(monkeypatch):
    encoder, asked, encode = packing.Ids(queries.tokenizer_path()), [], packing.Ids._encode_letters
    monkeypatch.setattr(packing.Ids, "_encode_letters", lambda self, words: asked.extend(words) or encode(self, words))
    for texts in (["Ab cd, ab's", "ñandú cd"], ["zz ab", "漢 cd"], []):
        assert encoder.of(texts) == [plain_ids(t) for t in texts]
    assert asked == ["ab", "cd", "ñandú", "zz"]
    assert list(encoder.words.values()) == list(range(len(encoder.ids)))


def test_fullest_combination_against_all_subsets():
    rng = np.random.default_rng(3)
    for _ in range(60):
        lengths, room = rng.integers(1, 30, rng.integers(1, 9)), int(rng.integers(1, 60))
        sums = {0}
        for x in lengths.tolist():
            sums |= {s + x for s in sums}
        available = np.bincount(lengths, minlength=61).tolist()
        chosen = packing.fullest(available, room, (1 << room + 1) - 1)
        assert sum(chosen) == max(s for s in sums if s <= room)
        assert all(chosen.count(x) <= available[x] for x in chosen)


def test_packing_round_trip(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    docs = docs.unionByName(spark.createDataFrame([(9001, None, "", "", 0), (9002, "", "", "", 0), (9003, "long words " * 9000, "", "", 0)], docs.schema))
    placed = stage(packing.pack_documents(docs, queries.tokenizer_path()), "placed")
    got = placed.toPandas()
    whole = {r.doc_id: plain_ids(r.text or "") + b"\1\0\0\0" for r in docs.collect()}
    assert got.length.max() <= 4096 and sum(map(len, whole.values())) == 4 * got.length.sum()
    for r in got.itertuples():
        part = whole[r.doc_id][4 * r.start : 4 * (r.start + r.length)]
        assert r.start == 4096 * r.piece and r.ids_crc32 == zlib.crc32(part)
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert (s.offset.values == np.cumsum([0, *s.length.values[:-1]])).all() and s.length.sum() <= 4096
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 4096) + 1
    sequences = packing.sequences(docs, placed, queries.tokenizer_path()).collect()
    at = {s: g.sort_values("offset") for s, g in got.groupby("sequence_id")}
    for r in sequences:
        want = b"".join(whole[p.doc_id][4 * p.start : 4 * (p.start + p.length)] for p in at[r.sequence_id].itertuples())
        assert np.array(r.ids, dtype="<i4").tobytes() == want


def test_packing_of_awkward_rows(spark):
    got = packing.pack_documents(awkward(spark), queries.tokenizer_path(), sequence=64).collect()
    assert {r.length for r in got if r.doc_id in (3, 4, 5)} == {1}
    assert sum(r.piece == 0 for r in got) == len(AWKWARD)
    assert packing.pack_documents(awkward(spark, []), queries.tokenizer_path()).count() == 0


# WARC --------------------------------------------------------------------------------------------

PAGES = "page_id BIGINT, url STRING, html STRING, record_type STRING, payload STRING, hex_digest STRING"
PAGE_ROWS = [
    (5, "http://a/é?x=1", "same\r\n\r\nWARC/1.1\r\n", None, None, None),
    (2, "http://b", "same\r\n\r\nWARC/1.1\r\n", None, None, None),
    (9, None, "same\r\n\r\nWARC/1.1\r\n", None, None, None),
    (3, "with\r\nbreak", None, None, None, None),
    (4, "x", "", None, None, None),
    (None, "y", "lone", None, None, None),
    (7, "z", "é" * 70_000, None, None, None),
]


def test_archives_round_trip(spark):
    got = {r[0]: tuple(r)[1:] for r in warc.pages_through_archives(spark.createDataFrame(PAGE_ROWS, PAGES)).collect()}
    d = warc.payload_digest
    same = "same\r\n\r\nWARC/1.1\r\n".encode()
    assert got == {
        2: (len(same), d(same), "response", None),
        5: (len(same), d(same), "revisit", 2),
        9: (len(same), d(same), "revisit", 2),
        3: (0, d(b""), "response", None),
        4: (0, d(b""), "revisit", 3),
        None: (4, d(b"lone"), "response", None),
        7: (140_000, d("é".encode() * 70_000), "response", None),
    }
    assert warc.pages_through_archives(spark.createDataFrame([], PAGES)).count() == 0


def test_short_payloads_are_not_revisited(spark):
    got = warc.pages_through_archives(spark.createDataFrame(PAGE_ROWS, PAGES), least_bytes=5)
    assert got.where("record_type = 'revisit'").count() == 2


def test_filters_are_pushed_and_payloads_skipped(spark):
    path = fresh_path(spark, "archive")
    warc.write_pages(spark.createDataFrame(PAGE_ROWS, PAGES), path)
    revisits = warc.read_archive(spark, path).where("record_type = 'revisit' AND refers_to IN (2, 3)")
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        revisits.explain("formatted")
    plan = plan.getvalue()
    assert "EqualTo(record_type,revisit)" in plan and "In(refers_to" in plan
    assert {r.page_id for r in revisits.collect()} == {5, 9, 4}
    assert "payload" not in warc.read_archive(spark, path, with_payload=False).columns
    assert {r.uri for r in warc.read_archive(spark, path).collect()} >= {"http://a/é?x=1", "with break", None}


def test_block_of_an_unwanted_record_is_not_read():
    class Counting(io.BytesIO):
        read_bytes = 0

        def read(self, n=-1):
            self.read_bytes += n
            return super().read(n)

    one = warc.record(1, "u", "response", b"x" * 1000, "D", None)
    two = warc.record(2, "u", "revisit", b"", "D", 1)
    stream = Counting(one + two)
    rows = list(warc.read_records(stream, {"record_type": {"revisit"}}, True))
    assert [r[0] for r in rows] == [2] and stream.read_bytes < 200
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(one[:-500]), {}, True))
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(b"no record\r\n"), {}, True))


def test_only_files_of_the_manifest_are_read(spark, tmp_path):
    kept = warc.record(1, "u", "response", b"a", "D", None)
    (tmp_path / "a.warc").write_bytes(kept)
    (tmp_path / "left-behind.warc").write_bytes(kept)
    assert warc.read_archive(spark, str(tmp_path)).count() == 2
    (tmp_path / warc.MANIFEST).write_text(json.dumps(["a.warc"]))
    assert warc.read_archive(spark, f"file://{tmp_path}").count() == 1


@pytest.mark.parametrize("most", [64 << 20, 50])
@pytest.mark.parametrize("make", [
    lambda: archive_of({"a.bin": bytes(range(256)) * 9, "conf.txt": b"password=hunter2secret\n"}),
    lambda: "na\xefve caf\xe9, d\xe9j\xe0 vu\npassword=hunter2secret\n\xe9t\xe9".encode("latin-1"),
    lambda: b"\x00\xff" * 300 + b"password=hunter2secret" + b"\xff\x00" * 300,
])
def test_secrets_beside_unreadable_bytes_of_compressed_content(make, most, monkeypatch):
    monkeypatch.setattr(secret_scan, "MOST_UNPACKED", most)
    word = base64.b64encode(gzip.compress(make())).decode()
    base, found, _, _ = secret_scan.scan_layers(f"see {word} there")
    end = 4 + len(word.rstrip("="))
    assert (4, 0) in {(a, kind) for a, kind, b in found if b - a >= end - 4} and not [f for f in base if f[1] == 0]


def test_unreadable_compressed_content_shows_nothing():
    word = base64.b64encode(gzip.compress(bytes(range(128, 256)) * 50)).decode()
    assert not [f for f in secret_scan.scan_layers(f"see {word} there")[1] if f[1] == 0]


def archive_of(files: dict[str, bytes]) -> bytes:
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w") as tar:
        for name, content in files.items():
            entry = tarfile.TarInfo(name)
            entry.size = len(content)
            tar.addfile(entry, io.BytesIO(content))
    return out.getvalue()


def foreign_record(kind: str, block: bytes, *more: str) -> bytes:
    head = ["WARC/1.0", f"WARC-Type: {kind}", "WARC-Record-ID: <urn:uuid:7f2c0c1e-0000-4000-8000-0123456789ab>", *more]
    return "\r\n".join([*head, f"Content-Length: {len(block)}"]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_archives_of_other_writers(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n<p>far</p>"
    records = [
        foreign_record("warcinfo", b"software: other\r\n"),
        foreign_record("request", b"GET / HTTP/1.1\r\n\r\n", "WARC-Target-URI: http://far/"),
        foreign_record("response", http, "WARC-Target-URI: http://far/"),
        foreign_record("revisit", b"", "WARC-Refers-To: <urn:uuid:1>"),
        warc.record(-4, "http://near/", "response", b"near", "D", None),
    ]
    (tmp_path / "plain.warc").write_bytes(b"".join(records))
    (tmp_path / "members.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    got = warc.read_archive(spark, str(tmp_path))
    rows = [(None, "warcinfo", None), (None, "request", None), (None, "response", b"<p>far</p>"),
            (None, "revisit", None), (-4, "response", b"near")]
    found = [(r.page_id, r.record_type, r.payload and bytes(r.payload)) for r in got.collect()]
    assert sorted(found, key=str) == sorted(rows * 2, key=str)
    assert got.where("record_type = 'response' AND uri = 'http://far/'").count() == 2


@pytest.mark.parametrize("record_id", ["", "<>", "<urn:page:>", "<urn:page:x>", "<urn:page:99999999999999999999>", "<urn:uuid:5>"])
def test_ids_that_name_no_page(record_id):
    assert warc._page_of(record_id) is None


# Lines of a site ---------------------------------------------------------------------------------


def test_boilerplate_of_a_site(spark):
    def page(i: int, host: str, *lines: str) -> tuple:
        body = "".join(f"<div class='x'><b>{x}</b> </div>" for x in lines)
        return i, f"https://user@{host}:80/p{i}", f"<html><script>var a='<p>';</script><!-- c --><body>{body}</body>"

    rows = [page(i, "A.example", "Menu", f"own {i}", "Menu") for i in range(6)]
    rows += [page(10 + i, "b.example", "Menu", f"text {i}") for i in range(2)]
    rows += [(20, None, "<p>Menu</p>"), (21, "nonsense", "<p>Menu"), (22, "http://a.example/x", None), (None, "http://a.example", "")]
    pages = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING").withColumn("lines", F.lit(1)).withColumn("host", F.lit(2))
    got = {r[0]: tuple(r)[1:] for r in line_dedup.drop_boilerplate(pages).collect()}
    assert got[3] == ("a.example", 3, 2, "own 3")
    assert got[11] == ("b.example", 2, 0, "Menu\ntext 1")
    assert got[20] == ("", 1, 0, "Menu") and got[21] == ("", 1, 0, "Menu")
    assert got[22] == ("a.example", 0, 0, "") and got[None] == ("a.example", 0, 0, "")
    assert line_dedup.drop_boilerplate(pages.where("1 = 0")).count() == 0
    at_ratio = line_dedup.drop_boilerplate(pages, ratio=6 / 8).where("n_dropped > 0")
    assert at_ratio.count() == 0


# Benchmark questions -----------------------------------------------------------------------------

ITEM = "A farmer named John has 12 cows and sells 5 of them to Mary for 300 dollars. How many cows does John have after he sells the cows?"
AGAIN = "Intro text here. " + ITEM.replace("John", "Peter").replace("12", "47").replace("Mary", "Anna").replace("300", "1,250.5").replace("dollars", "euros") + " Thanks."
BROKEN = ITEM.replace("does John", "does Mary").replace("sells the", "paints 9 old")


def leak_tables(spark):
    benchmark = spark.createDataFrame([(1, ITEM), (2, "too short"), (3, None), (4, "one two three four five six seven eight nine ten")], "item_id BIGINT, text STRING")
    rows = [(1, ITEM), (2, AGAIN), (3, BROKEN), (4, "A farmer named John has cows."), (5, ITEM.lower()), (6, "ten nine eight one two three four five six seven eight nine ten ten"), (7, None), (8, ""), (None, ITEM), (9, "too short")]
    docs = [(i, t, None, None, None) for i, t in rows]
    return awkward(spark, docs), benchmark.withColumn("key", F.lit(0))


def test_leaks_with_other_values(spark):
    docs, benchmark = leak_tables(spark)
    got = {r.doc_id: (r.n_leaked, r.item_id) for r in decontamination.leak_report(docs, benchmark).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (0, None), 4: (0, None), 5: got[5], 6: (1, 4), 7: (0, None), 8: (0, None), None: (1, 1), 9: (0, None)}
    kept = decontamination.drop_leaks(docs, benchmark)
    assert kept.schema == docs.schema and {1, 2, 6}.isdisjoint({r.doc_id for r in kept.select("doc_id").collect()})
    assert kept.where("doc_id IS NULL").count() == 0


def test_leaks_are_judged_by_row(spark):
    words = ITEM.split()
    half = [" ".join(words[: len(words) // 2]), " ".join(words[len(words) // 2 :])]
    rows = [(None, half[0]), (None, half[1]), (5, ITEM), (5, "a clean text under the id of a leak"), (None, ITEM), (None, ITEM)]
    docs = awkward(spark, [(i, t, None, None, None) for i, t in rows])
    benchmark = spark.createDataFrame([(1, ITEM)], "item_id BIGINT, text STRING")
    report = decontamination.leak_report(docs, benchmark).collect()
    assert sorted((r.doc_id is None, r.n_leaked) for r in report) == [(False, 0), (False, 1), (True, 0), (True, 0), (True, 1), (True, 1)]
    kept = [r.text for r in decontamination.drop_leaks(docs, benchmark).collect()]
    assert sorted(kept) == sorted([*half, rows[3][1]])


def test_inconsistent_slots_are_no_leak(spark):
    docs = awkward(spark, [(1, ITEM.replace("does John", "does Mary"), None, None, None)])
    benchmark = spark.createDataFrame([(1, ITEM)], "item_id BIGINT, text STRING")
    windows = decontamination.benchmark_windows(benchmark)
    assert decontamination.candidates(docs, windows).count() == 1
    assert decontamination.leaks(docs, benchmark).count() == 0


def leaked(spark, item: str, *texts: str) -> list[bool]:
    """Whether each text leaks the item."""
    docs = awkward(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    benchmark = spark.createDataFrame([(1, item), (2, None)], "item_id BIGINT, text STRING")
    found = decontamination.leak_report(docs, benchmark).where("item_id = 1").collect()
    return [i in {r.doc_id for r in found} for i in range(len(texts))]


def test_leaks_in_other_letter_case(spark):
    docs, benchmark = leak_tables(spark)
    got = {r.doc_id: (r.n_leaked, r.item_id) for r in decontamination.leak_report(docs, benchmark).collect()}
    assert got[5] == (1, 1)
    values = ITEM.replace("12", "47").replace("300", "8")
    cases = [ITEM.upper(), ITEM.title(), values.lower(), ITEM.swapcase(), BROKEN.lower(), "A FARMER HAS COWS."]
    assert leaked(spark, ITEM, *cases) == [True] * 4 + [False] * 2


def test_long_quotes_and_longer_names_are_leaks(spark):
    words = [f"{'abcdefghij'[k // 10]}{'klmnopqrst'[k % 10]}word" for k in range(100)]
    words[10:12], words[40] = ["Anna", "12"], "Anna"
    item = " ".join(words)
    other = item.replace("Anna", "Mary Ann", 1).replace("Anna", "Mary Ann").replace("12", "9")
    broken = item.replace("Anna", "Peter", 1)
    cases = [
        " ".join(words[:70]), " ".join(words[30:60]), " ".join(words[30:59]), " ".join(words[31:50] + words[:20]),
        " ".join(other.split()[5:60]), " ".join(broken.split()[5:45]), " ".join(broken.split()[5:75]),
    ]
    assert leaked(spark, item, *cases) == [True, True, False, False, True, True, True]
    assert leaked(spark, ITEM, ITEM.replace("John", "Mary Ann"), BROKEN) == [True, False]


def test_items_without_plain_windows_are_found_as_a_whole(spark):
    items = ["12 + 7 = 19", "three short words", "5 km, 6 km, 7 km; 8 km and 9 km", None, "", "too short"]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id BIGINT, text STRING")
    texts = ["Say 12 + 7 = 19.", "12 7 20", "THREE short. Words!", "a 5 km, 6 km, 7 km; 8 km and 9 km b", "5 km, 6 km", "", None, "too short"]
    docs = awkward(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    want = {(0, 0, 1, 1), (2, 1, 1, 1), (3, 2, 1, 1)}
    assert {tuple(r) for r in decontamination.leaks(docs, benchmark).collect()} == want


def test_leaks_by_shuffle_and_of_empty_tables(spark, monkeypatch):
    docs, benchmark = leak_tables(spark)
    want = rows_of(decontamination.leak_report(docs, benchmark))
    monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", 0)
    assert rows_of(decontamination.leak_report(docs, benchmark)) == want
    assert decontamination.leak_report(docs.where("1 = 0"), benchmark).count() == 0
    assert decontamination.leak_report(docs, benchmark.where("1 = 0")).where("n_leaked > 0").count() == 0


# Secrets -----------------------------------------------------------------------------------------

SECRET = "password=hunter2secret"


def added(text: str) -> list[tuple[str, str]]:
    base, found, _, _ = secret_scan.scan_layers(text)
    assert set(base) <= set(found)
    return sorted((secret_scan.KINDS[k], text[a:b]) for (a, k, b), depth in found.items() if depth)


def test_base_kinds():
    text = f"x {SECRET} API-key: no, apikey : 'abcde' ApiKey:\"abcdef\" AKIA{'A' * 16} AKIA{'B' * 15} {'0af' * 8} {'0af' * 7}"
    base, found, layers, _ = secret_scan.scan_layers(text)
    assert [(secret_scan.KINDS[k], text[a:b]) for a, k, b in base] == [
        ("assign", SECRET), ("assign", 'ApiKey:"abcdef'), ("access", "AKIA" + "A" * 16), ("hex", "0af" * 8)
    ]
    assert secret_scan.scan_layers("ſecret=abcdefgh toKen=abcdefgh")[0] == []


@pytest.mark.parametrize(
    "text, want",
    [
        (urllib.parse.quote(SECRET, safe=""), "password%3Dhunter2secret"),
        (urllib.parse.quote(urllib.parse.quote("é " + SECRET, safe=""), safe=""), "password%253Dhunter2secret"),
        ("pa%73sword=%68unter2secret", "pa%73sword=%68unter2secret"),
        ("".join(f"\\u{ord(c):04x}" for c in SECRET), "".join(f"\\u{ord(c):04x}" for c in SECRET)),
        ("&#112;ass\\x77ord=hunter2secret", "&#112;ass\\x77ord=hunter2secret"),
    ],
)
def test_layers_map_to_the_original(text, want):
    assert ("assign", want) in added("start " + text + " end")


def test_base64_and_compressed_layers():
    word = base64.b64encode(gzip.compress(f"{SECRET} AKIA{'Q' * 16}".encode())).decode()
    assert {k for k, _ in added(f"see {word} .")} == {"assign", "access"}
    deep = base64.b64encode(base64.urlsafe_b64encode(zlib.compress(urllib.parse.quote(SECRET, safe="").encode()))).decode()
    assert [k for k, _ in added(deep)] == ["assign"]
    (kind, part), = added("a " + base64.b64encode(f"padding padding {SECRET} padding".encode()).decode())
    assert kind == "assign" and len(part) <= 4 * len(SECRET) // 3 + 8


def test_layers_end():
    assert secret_scan.scan_layers("%2525" * 3 + "41")[2] == 4
    nested = SECRET
    for _ in range(12):
        nested = base64.b64encode(nested.encode()).decode()
    assert [k for k, _ in added(nested)] == ["assign"]
    assert added("plain ordinary words and nothing else of notehere") == []


def test_unpacking_is_bounded(monkeypatch):
    monkeypatch.setattr(secret_scan, "MOST_UNPACKED", 1000)
    word = base64.b64encode(gzip.compress(SECRET.encode() + b" x" * 10_000)).decode()
    base, found, _, cut = secret_scan.scan_layers(word)
    assert cut == 1 and len(found) == len(base) + 1


@pytest.mark.parametrize(
    "filler", [b" x" * 5_000, b"\n" * 5_000, b"x" * 5_000, "é, ".encode() * 5_000, b"token : %3D " * 700, b"lines of text\n" * 500]
)
@pytest.mark.parametrize("size", [7, 1000])
def test_compressed_content_is_scanned_to_its_end(monkeypatch, filler, size):
    monkeypatch.setattr(secret_scan, "MOST_UNPACKED", size)
    inner = base64.b64encode(b"some words around AKIA" + b"Q" * 16)
    text = filler + b" " + SECRET.encode() + b" " + filler + b" " + inner + b" " + filler
    word = base64.b64encode(zlib.compress(text)).decode()
    assert {("assign", word), ("access", word)} <= set(added(f"a {word} b"))


def test_all_members_are_scanned(monkeypatch):
    def of(*parts: bytes) -> list[tuple[str, str]]:
        return [k for k, _ in added(base64.b64encode(b"".join(parts)).decode())]

    plain, secret = gzip.compress(b"first member, nothing in it "), gzip.compress(SECRET.encode())
    for _ in range(2):
        assert of(plain, secret) == of(plain, plain, b"\0" * 8, secret) == of(plain, zlib.compress(SECRET.encode())) == ["assign"]
        assert of(gzip.compress(b"pass"), gzip.compress(b"word=hunter2secret")) == ["assign"]
        assert of(secret, gzip.compress(bytes(range(256)) * 9)) == of(gzip.compress(b"\xff" * 99), secret) == ["assign"]
        assert of(secret, plain[:9] + b"\xff" * 20) == ["assign"]
        assert set(of(plain, b" " + SECRET.encode())) == {"assign"}
        monkeypatch.setattr(secret_scan, "MOST_UNPACKED", 5)


@pytest.mark.parametrize("prefix", ["https://api.example.com/v1/", "a-", "x_y/", "id1", "b2", "c", "a/b/c/d/e/f/g/"])
def test_glued_base64(prefix):
    word = base64.b64encode(SECRET.encode()).decode()
    packed = base64.urlsafe_b64encode(zlib.compress(SECRET.encode() * 3)).decode()
    gzipped = base64.b64encode(gzip.compress(SECRET.encode() * 3)).decode()
    assert "assign" in {k for k, _ in added(f"see {prefix}{word} end")}
    assert "assign" in {k for k, _ in added(f"see {prefix}{gzipped} end")}
    if prefix[-1] in "/-_":
        assert "assign" in {k for k, _ in added(f"see {prefix}{packed} end")}


@pytest.mark.parametrize("end", ["\n", "\r\n", "\n  "])
def test_wrapped_base64(end):
    def wrapped(raw: bytes) -> str:
        word = base64.b64encode(raw).decode()
        return end.join(word[i : i + 76] for i in range(0, len(word), 76))

    text = "".join(f"line {i} é, " for i in range(5)) + SECRET + " and more text of the payload" * 3
    assert "assign" in {k for k, _ in added(f"body:{end}{wrapped(text.encode())}{end}{end}end")}
    noise = "".join(hashlib.sha256(bytes([i])).hexdigest()[:20] + " " for i in range(30))
    assert "assign" in {k for k, _ in added(wrapped(gzip.compress((noise + SECRET).encode())))}


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet=st.sampled_from("aeksrtoken=:'\"%20\\u0041&#;A9+/ \n"), max_size=60))
def test_any_text_ends_with_spans_inside(text):
    base, found, layers, cut = secret_scan.scan_layers(text)
    assert set(base) <= set(found) and all(0 <= a < b <= len(text) for a, _, b in found)


def test_secret_query_columns(spark):
    got = queries.QUERIES["op10_secret_scan"](spark, SF_DIR).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for r in got:
        base = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in secret_scan.scan(texts[r.doc_id] or ""))
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(base.split(",")) - {""} <= set(r.spans.split(","))
        assert [r.n_assign, r.n_access, r.n_hex] == [base.count(k) for k in secret_scan.KINDS]
    assert len(got) == len(texts)
    assert secret_scan.find_secrets(awkward(spark)).count() == len(AWKWARD)
    assert secret_scan.find_secrets(awkward(spark, [])).count() == 0
