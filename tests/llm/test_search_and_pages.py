"""Main text of pages, alignment of two tokenizers, ranked search."""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import html_extraction, lexical_search, queries, token_alignment
from tallyhouse.llm.html_extraction import main_text
from tests.llm.cases import AWKWARD, CLASHING, DOCS, awkward, rows_of

SF = "/root/testdata/sf0.001"
PARAGRAPH = "A paragraph with a good number of plain words that tell the story of the page."


# ---- op11 -------------------------------------------------------------------------------------

CASES = {
    "article among marked parts": (
        f"<html><head><title>T</title><style>p{{}}</style><script>var a='</p>'</script></head><body>"
        f"<header><h1>Site</h1><p>{PARAGRAPH}</p></header><nav><ul><li><a href=/>Home</a></ul></nav>"
        f"<div class='ad'>{PARAGRAPH}</div><article><h1>Head</h1><p>{PARAGRAPH}<p>Short."
        f"<form><p>{PARAGRAPH}</form><aside>{PARAGRAPH}</aside><p>End</p></article>"
        f"<section id='comments'><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></section>"
        f"<footer>&copy; {PARAGRAPH}</footer></body></html>",
        f"Head\n{PARAGRAPH}\nShort.\nEnd",
    ),
    "container without article": (
        f"<body class='has-sidebar'><div id=top>Menu <a href=/a>one</a> <a href=/b>two</a></div><div id=content>"
        f"<h2>Head</h2><p>{PARAGRAPH}</p><p>Ja.</p><p>{PARAGRAPH}</p></div>"
        f"<div class='cookie-notice'>{PARAGRAPH}</div></body>",
        f"Head\n{PARAGRAPH}\nJa.\n{PARAGRAPH}",
    ),
    "article inside a named wrapper": (
        f"<div class='page-with-widget widget'><article class='post-header'><p>{PARAGRAPH}</p></article></div>",
        PARAGRAPH,
    ),
    "title in the article's header": (
        f"<article><header class=entry-header><h1>Head</h1></header><p>{PARAGRAPH}</p>"
        f"<div class=article-comments><p>{PARAGRAPH}</p></div></article>",
        f"Head\n{PARAGRAPH}",
    ),
    "references, white space and inline markup": (
        "<article><p>a&nbsp;&amp;&amp;&lt;b&gt;\n\t<b>bo</b>ld&eacute;<br>next &#x41;</article>",
        "a &&<b> boldé next A",
    ),
    "unclosed and stray tags": (f"<article></b><p><b>{PARAGRAPH}<br><p>Two</div></i>\n<p>Three", f"{PARAGRAPH}\nTwo\nThree"),
    "teasers are not the article": (
        f"<div class=text><p>{PARAGRAPH * 4}</p><p>{PARAGRAPH * 4}</p></div><article><p>More</article>",
        f"{PARAGRAPH * 4}\n{PARAGRAPH * 4}",
    ),
    "hidden": (f"<article><p hidden>no<p style='display: none'>no<p>{PARAGRAPH}</article>", PARAGRAPH),
    "list and table": ("<main><ul><li>one<li>two</ul><table><tr><td>x<td>y</table></main>", "one\ntwo\nx\ny"),
    "inline advert": (f"<article><p>{PARAGRAPH} <span class=advert>Buy</span></article>", PARAGRAPH),
    "no content": ("<nav>a</nav><footer>b</footer><script>c", ""),
    "only an advert": (f"<div class=ad>{PARAGRAPH}</div>", ""),
    "no tag": ("  plain \n text ", "plain text"),
    "empty": ("", ""),
    "null": (None, ""),
    "markup only": ("<article><p></p></article><!-- x -->", ""),
}


@pytest.mark.parametrize("case", CASES)
def test_main_text(case):
    html, want = CASES[case]
    assert main_text(html) == want


def test_article_is_extracted_whole_whatever_its_lengths():
    for n in (1, 2, 5, 300):
        words = [f"w{i} " * (1 + i * 7 % 60) for i in range(n)]
        menu = "".join(f"<li><a href=/{i}>item {i}</a>" for i in range(n % 50))
        page = f"<nav><ul>{menu}</ul></nav><article>" + "".join(f"<p>{w}</p>" for w in words) + "</article><footer>f"
        assert main_text(page) == "\n".join(w.strip() for w in words)


def test_smoothing_and_threshold():
    ratios = np.array([0, 0, 40, 2, 40, 0, 0, 0, 0, 0, 0], dtype=float)
    assert html_extraction.clustered(ratios).tolist() == [False, False, True, True, True] + [False] * 6
    assert html_extraction.smooth(np.array([1.0])).shape == (1,)
    assert html_extraction.clustered(np.array([3.0])).tolist() == [True]


def test_pages_query_equals_a_plain_cut(spark):
    got = {r["page_id"]: r for r in queries.QUERIES["op11_html_extraction"](spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(got) == len(pages)
    for page in pages:
        inner = re.search(r"<article>(.*?)</article>", page["html"] or "", re.S)
        blocks = re.split(r"</?(?:p|h1)>", inner[1]) if inner else []
        lines = [" ".join(entities.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in blocks]
        text = "\n".join(x for x in lines if x)
        assert (got[page["page_id"]]["text"], got[page["page_id"]]["n_chars"]) == (text, len(text))
        assert got[page["page_id"]]["url"] == page["url"]


def test_pages_awkward(spark):
    long = "<article>" + "<p>" + "word " * 300_000 + "</article>"
    rows = [(1, "u", f"<p>{PARAGRAPH}"), (1, "u", f"<p>{PARAGRAPH}"), (None, None, None), (2, None, ""), (3, "v", long)]
    schema = "page_id BIGINT, url STRING, html STRING"
    pages = spark.createDataFrame(rows, schema).withColumns({c: F.lit(None).cast("string") for c in CLASHING})
    got = rows_of(html_extraction.extract(pages))
    text = ("word " * 300_000).strip()
    want = [(1, "u", PARAGRAPH, len(PARAGRAPH))] * 2 + [(2, None, "", 0), (3, "v", text, len(text)), (None, None, "", 0)]
    assert got == want
    assert html_extraction.extract(spark.createDataFrame([], schema)).collect() == []


# ---- op12 -------------------------------------------------------------------------------------


def plain_alignment(rows):
    """Token by token, with the tokenizers' own files; rows without their counts' order."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a_side = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    # The byte-level alphabet: printable characters stand for themselves, others from 256 on.
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}

    def b_bytes(piece):
        if re.fullmatch("<0x[0-9A-F]{2}>", piece):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    documents = []
    for doc_id, text in rows:
        groups = []
        if text:
            a = [(i, bytes(byte_of[c] for c in a_side.id_to_token(i))) for i in a_side.encode(" " + text, add_special_tokens=False).ids]
            b = [(i, b_bytes(b_side.id_to_piece(i))) for i in b_side.encode(text)]
            raw = (" " + text).encode()
            if b"".join(x for _, x in a) == raw == b"".join(x for _, x in b):
                at_a = at_b = 0
                own_a, own_b, a, b = [], [], a[::-1], b[::-1]
                while a or b:
                    if at_a <= at_b and a:
                        token, raw = a.pop()
                        at_a += len(raw)
                        own_a.append(token)
                    else:
                        token, raw = b.pop()
                        at_b += len(raw)
                        own_b.append(token)
                    if at_a == at_b:
                        groups.append((own_a, own_b))
                        own_a, own_b = [], []
        documents.append((doc_id, groups))
    links = [Counter((x, y) for a, b in groups for x in a for y in b) for _, groups in documents]
    counts = Counter(pair for own in links for pair in own)
    best = Counter()
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    found = []
    for (doc_id, groups), own in zip(documents, links):
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        found.append(
            (
                doc_id,
                sum(len(a) for a, _ in groups),
                sum(len(b) for _, b in groups),
                len(groups),
                sum(own.values()),
                sum(n for pair, n in own.items() if counts[pair] == best[pair[0]]),
                sum(n * counts[pair] for pair, n in own.items()),
                hashlib.sha256(text.encode()).hexdigest() if groups else "",
            )
        )
    return sorted(found, key=lambda r: tuple((v is None, str(v)) for v in r))


STRANGE = [
    (20, "<|endoftext|> and </s> are plain text <s> <unk> <0x41>"),
    (21, "a ▁ mark that one side cannot give back"),
    (22, "  two  spaces\n\n\n\tand tabs \r\n end  "),
    (23, "漢字かな交じり文 ünïcödé 👩‍👩‍👧‍👦 \u0000 ​"),
    (24, "ab" * 5000 + " " * 3000 + "x"),
    (25, " leading"),
]


@pytest.mark.parametrize("hot_pairs", [100_000, 20, 0])
def test_alignment_equals_token_by_token(spark, hot_pairs):
    rows = [(r[0], r[1]) for r in AWKWARD] + STRANGE
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    docs = docs.withColumns({c: F.lit(None).cast("string") for c in CLASHING + ["a", "b", "n", "row", "times", "best"]})
    got = token_alignment.alignment_report(docs, *queries.aligned_tokenizers(), hot_pairs=hot_pairs)
    want = plain_alignment(rows)
    assert rows_of(got) == want
    assert any(r[1] == 0 and r[0] == 21 for r in want) and any(r[1] > 0 and r[0] == 20 for r in want)


def test_alignment_query_on_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = queries.QUERIES["op12_token_alignment"](spark, SF)
    assert rows_of(got) == plain_alignment([tuple(r) for r in docs])


def test_alignment_of_no_documents(spark):
    empty = spark.createDataFrame([], DOCS)
    assert token_alignment.alignment_report(empty, *queries.aligned_tokenizers()).collect() == []


def test_large_groups_are_counted(monkeypatch):
    rng = np.random.default_rng(5)
    per_a, per_b = rng.integers(1, 9, 40), rng.integers(1, 9, 40)
    in_a, in_b = np.repeat(np.arange(40), per_a), np.repeat(np.arange(40), per_b)
    a, b = rng.integers(0, 5, len(in_a)), rng.integers(0, 4, len(in_b))
    want = Counter(int(x) * 4 + int(y) for x, g in zip(a, in_a) for y, h in zip(b, in_b) if g == h)
    for bound in (4096, 20, 0):
        monkeypatch.setattr(token_alignment, "LARGE_GROUP", bound)
        pairs, times = token_alignment._links(a, b, in_a, in_b, 4)
        assert dict(zip(pairs.tolist(), times.tolist())) == want and (np.diff(pairs) > 0).all()


def test_overlaps_of_both_directions():
    a = pd.DataFrame({"start": [0, 3, 4], "doc": [0, 0, 1], "number": [0, 1, 2]})
    b = pd.DataFrame({"start": [0, 2, 4], "doc": [0, 0, 1], "number": [0, 1, 2]})
    i, j = token_alignment.overlaps(a, b)
    assert list(zip(i.tolist(), j.tolist())) == [(0, 0), (0, 1), (1, 1), (2, 2)]


def test_only_starts_inside_a_token_are_looked_up_again(monkeypatch):
    asked, merge = [], pd.merge_asof
    monkeypatch.setattr(pd, "merge_asof", lambda left, *rest, **named: asked.append(len(left)) or merge(left, *rest, **named))
    a = pd.DataFrame({"start": [0, 3, 4, 6], "doc": [0, 0, 1, 1], "number": [0, 1, 2, 3]})
    b = pd.DataFrame({"start": [0, 2, 4], "doc": [0, 0, 1], "number": [0, 1, 2]})
    i, j = token_alignment.overlaps(a, b)
    assert list(zip(i.tolist(), j.tolist())) == [(0, 0), (0, 1), (1, 1), (2, 2), (3, 2)] and asked == [4, 1]
    i, j = token_alignment.overlaps(a, a)
    assert i.tolist() == j.tolist() == [0, 1, 2, 3] and asked[2:] == [4, 0]


def test_tokens_are_arrays_that_give_back_the_text():
    tok = token_alignment.tokenizers_of(*queries.aligned_tokenizers())
    texts = ["two words", "a ▁ mark", None, "", "漢 \U0001f600\x00 end"]
    a, b = tok.encode(texts)
    assert all(isinstance(x, np.ndarray) and x.dtype == np.int32 for x in a + b)
    for ids, entries in ((a, tok.a_bytes), (b, tok.b_bytes)):
        given = [b"".join(entries[i] for i in x) for x in ids]
        assert given == [b" two words", b"", b"", b"", " 漢 \U0001f600\x00 end".encode()]


# ---- op13 -------------------------------------------------------------------------------------


def plain_search(docs, items, k=10):
    import math

    terms = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
    fold = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    held = [(i, Counter(terms.findall((t or "").translate(fold)))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    total, df = sum(sum(c.values()) for _, c in held), Counter(t for _, c in held for t in c)
    found = []
    for item_id, text in items:
        scores = []
        for doc_id, c in held:
            m = 10 + (90 * sum(c.values()) * len(held)) // total
            score = 0
            for t in set(terms.findall((text or "").translate(fold))) & set(c):
                w = math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df[t] + 1)))
                score += w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id))
        for rank, (score, _, doc_id) in enumerate(sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:k], 1):
            found.append((item_id, rank, doc_id, -score))
    return sorted(found, key=lambda r: tuple((v is None, str(v)) for v in r))


ITEMS = [
    (1, "quick brown fox"),
    (2, "The LAZY lazy dog, the dog!"),
    (3, None),
    (4, ""),
    (5, "nowhere-at_all zzz"),
    (6, "word5 word7 漢字 é ñ"),
    (6, "word5 word7 漢字 é ñ"),
    (None, "end one"),
    (7, "of the"),
]


def test_search_equals_plain_search(spark, monkeypatch):
    ties = [(100 - i, f"tied text number {i % 3}", None, None, None) for i in range(40)]
    rows = AWKWARD + ties
    items = ITEMS + [(8, "tied TEXT"), (9, "number 1")]
    docs = awkward(spark, rows).withColumns({c: F.lit(1) for c in ("n", "terms", "tfs", "item", "salt", "rank")})
    want = plain_search([(r[0], r[1]) for r in rows], items)
    asked = spark.createDataFrame(items, "item_id BIGINT, text STRING").withColumn("rank", F.lit(0)).repartition(3)
    assert rows_of(lexical_search.search(docs, asked)) == want
    # Small blocks and tiles give the same rows.
    monkeypatch.setattr(lexical_search, "BLOCK_ITEMS", 3)
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", 6)
    assert rows_of(lexical_search.search(docs, asked)) == want


def test_search_without_rows(spark):
    none, items = spark.createDataFrame([], DOCS), spark.createDataFrame(ITEMS, "item_id BIGINT, text STRING")
    assert lexical_search.search(none, items).collect() == []
    assert lexical_search.search(awkward(spark), items.limit(0)).collect() == []


def test_tiles_are_exact_and_ties_safe():
    assert lexical_search.tile_width(1, 1) == lexical_search.TILE_TERMS
    for weight in (10**7, 40_000_000, 10**12):
        width = lexical_search.tile_width(weight, 1_000_000)
        assert width == 1 or width * weight * 1_000_000 < 2**53
    best = lexical_search.Best(1, 2)
    best.add(np.array([[5], [5], [5]]), np.array([9, 8, 7]))
    best.add(np.array([[5], [4]]), np.array([1, 2]))
    assert [x.tolist() for x in best.kept[0]] == [[5, 5], [1, 7]]


def test_vocabulary_tiles_add_up(spark, monkeypatch):
    docs = awkward(spark)
    items = spark.createDataFrame(ITEMS, "item_id BIGINT, text STRING")
    want = rows_of(lexical_search.search(docs, items))
    block = next(lexical_search.blocks_of(items))
    held = lexical_search.held_terms(docs, block).toArrow().to_batches()
    documents, words = sum(b.num_rows for b in held), sum(sum(b.column("n").to_pylist()) for b in held)
    df = Counter(t for b in held for terms in b.column("terms").to_pylist() for t in terms)
    weights = np.array([float(lexical_search.weight(documents, df[t])) if df[t] else 0 for t in range(len(block.vocabulary))])
    monkeypatch.setattr(lexical_search, "TILE_TERMS", 2)
    monkeypatch.setattr(lexical_search, "TILE_DOCUMENTS", 3)
    monkeypatch.setattr("pyspark.TaskContext.get", lambda: type("T", (), {"partitionId": lambda self: 0})())
    size = (len(block.vocabulary), block.items)
    tiled = lexical_search._best_of_task(iter(held), size, weights, documents, words, 10)
    got = sorted((block.item_ids[r["item"]], r["score"]) for b in tiled for r in b.to_pylist() if block.item_ids[r["item"]])
    assert got == sorted((r[0], r[3]) for r in want if r[0])
