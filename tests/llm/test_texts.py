import itertools
import json
import re
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from veilframe.llm import chat_perspectives, curve_packing, html_main_text, licence_digests, unigram_pieces
from veilframe.llm.queries import tokenizer_file

SF = "/root/testdata/sf0.001"


# --- perspectives

def render(turns, who):
    text, spans = "", []
    for _, speaker, said in sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2])):
        own = speaker == who
        head = "<|system|>\n" if speaker == "system" else "<|assistant|>\n" if own else f"<|user name={speaker}|>\n"
        body = said + "<|end|>\n"
        if own:
            spans.append((len(text) + len(head), len(text) + len(head) + len(body)))
        text += head + body
    return text, spans


def test_every_participant_is_the_assistant_once(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "ann", "hi 漢字"), (1, 2, "bob", "hello"), (1, 3, "ann", "so"), (1, 3, "ann", "so"), (2, 0, "system", "alone"), (3, 5, "cat", None), (3, None, "", "first")]
    df = spark.createDataFrame([(*r, "x", 9) for r in rows], "conv_id long, turn long, role string, text string, part string, own int")
    got = {(r.conv_id, r.perspective): (r.text, [(s.start, s.end) for s in r.spans]) for r in chat_perspectives.rotate(df).collect()}
    want = {}
    for conv in (1, 2, 3):
        own = [(t, r or "unknown", x or "") for c, t, r, x in rows if c == conv]
        for who in {r for _, r, _ in own} - {"system"}:
            want[conv, who] = render(own, who)
    assert got == want
    for text, spans in got.values():
        assert all(text[a:b].endswith("<|end|>\n") for a, b in spans) and len(spans) >= 1
    assert chat_perspectives.rotate(df.limit(0)).count() == 0


def test_pieces_of_long_conversations_make_the_whole(spark):
    """A null conversation of which a third is one repeated row, and another with null turns; joined pieces are the whole rendering, spans included."""
    rows = [(None, i % 300, "ab"[i % 2], f"t{i * 7919 % 1009}") for i in range(1000)] + [(None, 77, "a", "again")] * 500
    rows += [(5, None if i % 3 else i, "cd"[i % 2], f"u{i}") for i in range(130)] + [(6, 1, "e", "short")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    got = {}
    for r in sorted(chat_perspectives.rotate(df, piece_rows=60).collect(), key=lambda r: r.piece):
        text, spans, n = got.setdefault((r.conv_id, r.perspective), ("", [], []))
        got[r.conv_id, r.perspective] = (text + r.text, spans + [(len(text) + s.start, len(text) + s.end) for s in r.spans], n + [r.n_messages])
    for conv, people, sizes in ((None, "ab", [60] * 25), (5, "cd", [60, 60, 10]), (6, "e", [1])):
        for who in people:
            text, spans = render([r[1:] for r in rows if r[0] == conv], who)
            assert got.pop((conv, who)) == (text, spans, sizes)
    assert not got


# --- packing

PATH = tokenizer_file("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def check_packing(rows, pieces, tokenizer, sequence=2048):
    by_doc = {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        own = sorted(by_doc[doc_id], key=lambda p: p.start)
        assert [p.start for p in own] == [sum(q.length for q in own[:i]) for i in range(len(own))]
        assert sum(p.length for p in own) == len(ids) and {p.doc_tokens for p in own} == {len(ids)}
        assert all(zlib.crc32(ids[p.start:p.start + p.length].tobytes()) == p.ids_crc32 for p in own)
    at = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == at.get(p.sequence_id, 0)
        at[p.sequence_id] = p.offset + p.length
    assert max(at.values()) <= sequence
    return sum(0 if n & (n - 1) == 0 else sequence - n for n in at.values())


def test_packing(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = curve_packing.pack(docs, PATH, partitions=5).collect()
    assert check_packing([(r.doc_id, r.text) for r in docs.collect()], got, tokenizer) == 0


def test_packing_of_odd_rows(spark, tokenizer):
    rows = [(1, None), (2, ""), (3, "a\x1cb it's <|endoftext|> É ﬁ 漢字"), (4, "word " * 30_000), *((10 + i, "same text") for i in range(300))]
    df = spark.createDataFrame([(*r, 1, 2.0) for r in rows], "doc_id long, text string, n int, key double")
    assert check_packing(rows, curve_packing.pack(df, PATH, partitions=4).collect(), tokenizer) == 0
    assert curve_packing.pack(df.limit(0), PATH).count() == 0
    twice = curve_packing.pack(df.where("doc_id = 2").union(df.where("doc_id = 2")).union(df.where("doc_id is null")), PATH).collect()
    assert sorted((p.doc_id, p.length) for p in twice) == [(2, 1), (2, 1)]


def test_hilbert_neighbours_are_adjacent():
    cells = np.array(list(itertools.product(range(8), repeat=3)))
    keys = curve_packing.hilbert_key(cells, 3)
    assert sorted(keys.tolist()) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_words_are_encoded_as_whole_texts_are(spark, tokenizer):
    import pyarrow as pa

    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    texts += ["ΟΔΟΣ Σίσυφος, İstanbul ñ$$ ñ it's l'été 12,345 漢字 ǅ ŉ n\u0303 don't.. <|endoftext|> a\x1cb \xa0x\x85 Straße!ẞ ''", "", " ", "....", None, "word" * 5000]
    known = curve_packing._tokenizer(PATH)
    for _ in range(2):  # the second time from memory
        flat, sizes = curve_packing.encode(pa.array(texts), known)
        for text, ids in zip(texts, np.split(flat, np.cumsum(sizes)[:-1]), strict=True):
            assert ids.tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


def test_neighbours_on_the_curve_are_packed_together(spark):
    """Two kinds of text in random order of ids: nearly all sequences hold one kind alone, and copies lie side by side."""
    rng = np.random.default_rng(0)
    kinds = ["sea ship wind sail wave salt".split(), "tax law court judge bill fee".split()]
    rows = [(i, " ".join(rng.choice(kinds[i * 7919 % 1009 % 2], 120))) for i in range(600)]
    rows += [(1000 + i, "ten copies of one text about ships and courts and bread " * 20) for i in range(10)]
    pieces = curve_packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), PATH, partitions=4).collect()
    kind = {i: i * 7919 % 1009 % 2 for i in range(600)}
    by_sequence = {}
    for p in pieces:
        if p.doc_id < 1000:
            by_sequence.setdefault(p.sequence_id, set()).add(kind[p.doc_id])
    assert np.mean([len(k) == 1 for k in by_sequence.values()]) > 0.85
    order = [p.doc_id for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)) if p.start == 0]
    at = [i for i, d in enumerate(order) if d >= 1000]
    assert at[-1] - at[0] == 9


# --- html

def test_articles_of_the_pages(spark):
    import html

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    for r in html_main_text.extract(pages).collect():
        article = re.sub(r"<[^>]*\Z", "", source[r.page_id].split("<article>")[1].split("</article>")[0])
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)


PAGE = """<!doctype html><html><head><title>t</title><style>p{x:"</p>"}</style></head><body class="home"><!-- <p>no</p> --><header><h1>Site</h1></header>
<div class="cookie-notice">We <b>use</b> cookies</div><nav><ul><li><a href="/a>b">Home</a></ul></nav><main><article><header><h1>Title &amp; more</h1></header><p>One &lt;two&gt;<br>three&nbsp;four
<p class="ad">Buy!<p>Five<div id="comments"><p>first!</p><div>nested</div></div><aside>see also</aside><form>name <input></form><script>var a="<p>x</p>";</script><p>Six &#233; caf&eacute; &unknown; a < b</article></main><footer>&copy;</footer></body></html>"""


def test_roles_of_blocks():
    got = [t for role, t in html_main_text.blocks(PAGE) if role == html_main_text.ARTICLE]
    assert got == ["Title & more", "One <two> three four", "Five", "Six é café &unknown; a < b"]


def test_repeated_runs_of_undecided_blocks_go(spark):
    fixed = "All pages of this site carry this line of more than eight words at the top"
    rows = [(i, f"http://h.example/{i}", f"<body><div>{fixed}</div><div>{fixed} p{i} says q{i}</div><div>menu</div><p>Own text of page {i} with words that no other page has {i}</p></body>") for i in range(3)]
    rows += [(7, "http://other.example/", f"<div>{fixed}</div>"), (8, "http://h.example/0", rows[0][2])]
    got = {r.page_id: r.text for r in html_main_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(3):
        assert got[i] == f"p{i} says q{i}\nOwn text of page {i} with words that no other page has {i}"
    assert got[7] == fixed and got[8] == got[0]


def test_copies_of_an_article_are_kept(spark):
    page = "<nav>menu</nav><article><p>The same article of more than eight words is on both of the pages</p></article>"
    rows = [(1, "http://h/1", page), (2, "http://h/2", page.replace("menu", "other"))]
    assert html_main_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).where("n_chars > 60").count() == 2


def test_short_blocks_and_runs_over_blocks(spark):
    own = "{} is a text of page {} alone with {} and {} in all of its words"
    rows = [(i, f"http://h/{i}", f"<div>one two three</div><div>four five six seven eight</div><p>{own.format(*[f'x{i}'] * 4)}</p>" + ("<h2>Conclusion</h2>" if i < 2 else "") + f"<p>End {i}</p>") for i in range(5)]
    copy = "A whole text without any article element that two pages of one host have"
    rows += [(8, "http://two/1", f"<p class=a>{copy}</p><h2>Notes</h2>"), (9, "http://two/2", f"<p class=b>{copy}</p><h2>Notes</h2>")]
    got = {r.page_id: r.text for r in html_main_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(5):
        assert got[i] == own.format(*[f"x{i}"] * 4) + ("\nConclusion" if i < 2 else "") + f"\nEnd {i}"
    assert got[8] == got[9] == copy + "\nNotes"


def test_shared_lengths_equal_brute_force():
    rng = np.random.default_rng(3)
    for trial in range(20):
        rows = []
        for page in range(8):
            tokens = [f"t{x}" for x in rng.integers(0, 3, 25)]
            host, data = f"h{page % 2}", html_main_text.token_keys(tokens)
            rows += [(host, data[4 * i:4 * i + 24], page, page + (trial % 2 and page == 5)) for i in range(25)]
        rows.sort(key=lambda r: (r[0], r[1], r[2]))
        got = html_main_text.shared_lengths([r[0] for r in rows], [r[1] for r in rows], np.array([r[2] for r in rows]), np.array([r[3] for r in rows]))
        for (host, key, first, last), length in zip(rows, got, strict=True):
            others = [k for h, k, a, b in rows if h == host and (a, b) != (first, first)]
            want = next((n for n in range(len(key) // 4, 0, -1) if any(k[:4 * n] == key[:4 * n] for k in others)), 0)
            assert length == (want if first == last else len(key) // 4)


def test_repeated_runs_equal_brute_force(spark):
    """Pages without an article: what stays is what no other page of the host shares in a run of eight tokens."""
    rng = np.random.default_rng(5)
    shared = [[f"s{k}_{i}" for i in range(int(rng.integers(5, 30)))] for k in range(6)]
    rows = []
    for i in range(60):
        blocks = []
        for _ in range(int(rng.integers(1, 6))):
            own = [f"p{i}_{x}" for x in rng.integers(0, 10**6, int(rng.integers(1, 12)))]
            some = shared[rng.integers(len(shared))]
            blocks.append(" ".join(rng.choice([0, 1]) and [*own, *some] or [*some, *own]))
        rows.append((i, f"http://h{i % 3}/{i}", "".join(f"<p>{b}</p>" for b in blocks), blocks))
    windows = {}
    for i, url, _, blocks in rows:
        tokens = " ".join(blocks).split()
        for k in range(len(tokens) - 7):
            windows.setdefault((i % 3, *tokens[k:k + 8]), set()).add(i)
    df = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string").repartition(5)
    for window in (8, 16):
        got = {r.page_id: r for r in html_main_text.extract(df, window=window).collect()}
        for i, url, _, blocks in rows:
            tokens = " ".join(blocks).split()
            covered = np.zeros(len(tokens), bool)
            for k in range(len(tokens) - 7):
                if len(windows[(i % 3, *tokens[k:k + 8])]) > 1:
                    covered[k:k + 8] = True
            kept, at = [], 0
            for b in blocks:
                own = [t for t, c in zip(b.split(), covered[at:], strict=False) if not c]
                at += len(b.split())
                kept += [" ".join(own)] if own else []
            assert got[i].text == "\n".join(kept) and got[i].site_tokens == covered.sum()


def test_runs_outside_articles_are_counted(spark):
    foot = "all rights of this site belong to its owners and to nobody else at all"
    rows = [(i, f"http://h/{i}", f"<article><p>{foot} and the text of page {i}</p></article><footer>{foot} page{i}</footer>") for i in range(4)]
    got = html_main_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {(r.text, r.site_tokens) for r in got} == {(f"{foot} and the text of page {i}", 15) for i in range(4)}


def test_blocks_that_most_articles_of_a_host_have_go(spark):
    notice = "Our letter comes every week and tells all our readers what is new"
    credit = "This piece was first printed by the paper of {0} {0} {0} {0} {0} {0} {0} {0} and may be shared by all of its readers"
    own = "Here the page {0} says what {0} no other of the pages {0} has"
    page = lambda i, *more: "<article>" + "".join(f"<p>{b}</p>" for b in (own.format(f"a{i}"), *more, own.format(f"b{i}"), own.format(f"c{i}"))) + "</article>"
    rows = [(i, f"http://h/{i}", page(i, notice, credit.format(f"y{i}"))) for i in range(4)] + [(4, "http://h/4", page(4)), (5, "http://h/5", page(0, notice, credit.format("y0"))), (6, "http://h/6", "<article><p>Two.<p>Two.</article>")]
    rows += [(10 + i, f"http://few/{i}", page(i, *[notice] * (i < 2))) for i in range(5)]
    rows += [(20 + i, f"http://near/{i}", page(0, notice, f"version number {i}")) for i in range(4)]
    got = {r.page_id: r.text for r in html_main_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    for i in range(4):
        assert got[i] == "\n".join([own.format(f"a{i}"), credit.format(f"y{i}"), own.format(f"b{i}"), own.format(f"c{i}")])
    assert got[5] == got[0] and got[6] == "Two.\nTwo."
    assert [notice in got[10 + i] for i in range(5)] == [True, True, False, False, False]
    assert all(got[20 + i].count(notice) == 1 and got[20 + i].count("\n") == 4 for i in range(4))


def test_pages_of_odd_rows(spark):
    rows = [(1, None, None), (2, "", ""), (3, "x", "no tags at all"), (4, "http://h/", "<p>cut <b"), (5, "http://h/", "<nav>only menu"), (6, "http://h/", "<article>" + "<p>long text</p>" * 20_000), (6, "http://h/", "<!-- open")]
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], "page_id long, url string, html string, host string, run int")
    got = sorted((r.page_id, r.text[:12], r.n_chars) for r in html_main_text.extract(df).collect())
    assert got == [(1, "", 0), (2, "", 0), (3, "no tags at a", 14), (4, "cut", 3), (5, "", 0), (6, "", 0), (6, "long text\nlo", 199_999)]
    assert html_main_text.extract(df.limit(0)).count() == 0


# --- licences

def test_licence_texts(spark):
    mit = licence_digests.MIT_TERMS
    rows = [
        (1, "MIT Licence\n\nCopyright (c) 2020 Somebody\n\n" + mit.upper()), (2, mit.replace("sublicense", "sub-license").replace(" ", "\n ")), (3, mit + "\nand one more condition"),
        (4, "words\nLicensed under the Apache Licence, version 2.0!\nReleased under the MIT License.\n"), (5, None), (6, ""), (7, "© 2020 all of it\n!!"), (8, "Licensed under CC BY 4.0"), (8, "Licensed under CC BY 4.0"), (9, "x " * 100_000),
    ]
    df = spark.createDataFrame([(*r, "d", "l") for r in rows], "doc_id long, text string, digest string, licence string")
    for limit in (100, 0):
        got = sorted((r.doc_id, r.licence, r.digest is None, r.line_licences) for r in licence_digests.scan(df, licence_digests.known_licences(spark), limit).collect())
        assert got == [
            (1, "MIT", False, ""), (2, "MIT", False, ""), (3, None, False, ""), (4, None, False, "Apache-2.0,MIT"), (5, None, True, ""), (6, None, True, ""), (7, None, True, ""),
            (8, "CC-BY-4.0", False, "CC-BY-4.0"), (8, "CC-BY-4.0", False, "CC-BY-4.0"), (9, None, False, ""),
        ]
    assert licence_digests.scan(df.limit(0), licence_digests.known_licences(spark)).count() == 0
    plan = licence_digests.scan(df, licence_digests.known_licences(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


BSD_2 = """Copyright (c) 2021, Some Body
All rights reserved.

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""


def test_whole_licence_texts_beyond_the_list(spark):
    folder = Path("/usr/share/common-licenses")
    files = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0-only", "GPL-3": "GPL-3.0-only", "LGPL-2.1": "LGPL-2.1-only", "LGPL-3": "LGPL-3.0-only", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    rows = [(name, licence, (folder / name).read_text()) for name, licence in files.items() if (folder / name).exists()]
    rows = [("bsd", "BSD-2-Clause", BSD_2), ("bsd and more", None, BSD_2 + "\nand more"), *rows]
    df = spark.createDataFrame([(name, text) for name, _, text in rows], "doc_id string, text string")
    got = {r.doc_id: r.licence for r in licence_digests.scan(df, licence_digests.known_licences(spark)).collect()}
    assert got == {name: licence for name, licence, _ in rows}


# --- pieces

@pytest.fixture(scope="module")
def vocabulary():
    return unigram_pieces.build(unigram_pieces.read_pieces(Path(tokenizer_file("piece_bpe_32k.model")).read_bytes()))


def test_trie_has_every_piece_and_no_other(vocabulary):
    pieces = unigram_pieces.read_pieces(Path(tokenizer_file("piece_bpe_32k.model")).read_bytes())

    def walk(text):
        state = 0
        for b in text.encode():
            child = vocabulary.base[state] + b
            if child <= 0 or child >= len(vocabulary.check) or vocabulary.check[child] != state:
                return -1
            state = child
        return vocabulary.piece[state]

    assert all(walk(p) == i for i, (p, _, kind) in enumerate(pieces) if kind == unigram_pieces.NORMAL)
    known = {p for p, _, _ in pieces}
    assert all(walk(p + "zq") == -1 for p in list(known)[:3000] if p + "zq" not in known)


def plain_viterbi(text, pieces, v):
    """(score of the best segmentation) of one whole text, by trying every piece at every place."""
    marked = ("▁" + text.replace(" ", "▁")) if text else ""
    best = [0.0] + [-np.inf] * len(marked)
    for i in range(len(marked)):
        single = False
        for n in range(1, min(20, len(marked) - i) + 1):
            k = pieces.get(marked[i:i + n])
            if k is not None:
                single |= n == 1
                best[i + n] = max(best[i + n], best[i] + v.score[k])
        if not single:
            best[i + 1] = max(best[i + 1], best[i] + v.unknown_score)
    return best[-1]


def test_segmentation_is_the_best_one(spark, vocabulary):
    pieces = {p: i for i, (p, _, kind) in enumerate(unigram_pieces.read_pieces(Path(tokenizer_file("piece_bpe_32k.model")).read_bytes())) if kind == unigram_pieces.NORMAL}
    texts = [r.text[:400] for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    texts += ["", " ", "  two  spaces ", "a\nb\tc", "漢字 ゑ emoji 😀 ß", "x" * 300, "tail  ", "0123 4567"]
    bytes_of = set(vocabulary.byte_ids.tolist())
    coder = unigram_pieces.Coder(vocabulary)
    for text, ids in zip(texts, coder.encode(texts), strict=True):
        assert coder.decode(ids) == text
        runs, total = [k in bytes_of for k in ids.tolist()], 0.0
        total = sum(vocabulary.score[k] for k, b in zip(ids.tolist(), runs, strict=True) if not b)
        raw = b"".join(vocabulary.surface[k] for k, b in zip(ids.tolist(), runs, strict=True) if b).decode()
        assert np.isclose(total + len(raw) * vocabulary.unknown_score, plain_viterbi(text, pieces, vocabulary))


def test_the_library_agrees(vocabulary):
    """The same pieces and scores in the public library's own unigram mode."""
    import sentencepiece

    def varint(x):
        out = b""
        while x > 127:
            out, x = out + bytes([x & 127 | 128]), x >> 7
        return out + bytes([x])

    def put(n, value):
        return varint(n << 3) + varint(value) if isinstance(value, int) else varint(n << 3 | 2) + varint(len(value)) + value

    data = Path(tokenizer_file("piece_bpe_32k.model")).read_bytes()
    model, k = b"", 0
    for number, value in unigram_pieces._fields(data):
        if number == 1:
            own = dict(unigram_pieces._fields(value))
            value = put(1, own[1]) + varint(2 << 3 | 5) + np.float32(vocabulary.score[k]).tobytes() + put(3, own.get(3, 1))
            k += 1
        elif number == 2:
            value = b"".join(put(3, 1) if n == 3 else varint(n << 3 | 5) + x if n in (10, 15, 51) else put(n, x) for n, x in unigram_pieces._fields(value))
        model += put(number, value)
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    coder = unigram_pieces.Coder(vocabulary)
    for text in ("The quick brown fox.", " lead", "trail ", "a\nb", "漢字 ゑ 😀", "word  word", "éèç ñandú Straße"):
        assert coder.encode([text])[0].tolist() == library.encode(text)


def test_pieces_of_odd_rows(spark, vocabulary):
    rows = [(1, None), (2, ""), (3, "▁ marker"), (4, "long " * 60_000), (5, "same"), (5, "same"), (None, "x")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, ids string, decoded int")
    got = unigram_pieces.digests(unigram_pieces.encode_documents(df, vocabulary)).toPandas()
    assert len(got) == len(rows)
    assert got[got.doc_id == 1][["n_ids", "round_trip"]].values.tolist() == [[0, True]]
    assert got[got.doc_id == 3].round_trip.tolist() == [False] and got[got.doc_id != 3].round_trip.all()
    assert unigram_pieces.encode_documents(df.limit(0), vocabulary).count() == 0


@pytest.mark.parametrize(("page", "text"), [
    ('<div class="layout with-sidebar"><article><p>Whole article</p></article><div class="sidebar">Side</div></div>', "Whole article"),
    ('<div id="page" class="no-ads"><main><p>Main text</p></main></div><div class="ads">Buy</div>', "Main text"),
    ('<article><div class="post-header"><h1>Title</h1></div><p>Text</p><div class="article-footer">Written by A</div></article>', "Title\nText\nWritten by A"),
    ('<div role="main"><p>One</p><div><div>Two</div></div><div class="share-buttons">Share</div>Three</div><div>Other</div>', "One\nTwo\nThree"),
    ('<body><div>Top</div><section itemprop="articleBody"><p>Body</p></section><p>Below</p></body>', "Body"),
    ('<div class="site-header-wrapper"><p>Logo</p><main>Main</main></div>', "Main"),
    ('<div class="cookie-overlay"><p>Cookies</p></div><div class="overlay-page"><article>Text</article></div>', "Text"),
    ('<main><p>Text</p><div class="comments"><article>First!</article></div><div class="related-articles"><article>See</article></div><div class="widget"><article>Card</article></div></main>', "Text"),
    ('<article>Text<div class="post-comments"><p>First!</p></div><div class="comment-list">x</div><ul class="post-navigation"><li>Next</ul></article>', "Text"),
    ('<article><p>Left open<div class="sidebar"><p>Side</div><p>End', "Left open\nEnd"),
])
def test_class_names_of_wrappers_take_no_text_away(page, text):
    found = html_main_text.blocks(page)
    assert "\n".join(t for role, t in found if role == html_main_text.ARTICLE) == text


def test_copies_that_share_an_id_are_spread(spark, tokenizer):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(rng.choice("sea tax law ship".split(), 40))) for i in range(200)] + [(7, "one text that is loaded again and again " * 4)] * 3000 + [(None, "nameless " * 9)] * 500
    pieces = curve_packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), PATH, partitions=8)
    per_task = pieces.groupBy(F.spark_partition_id()).count().toPandas()["count"]
    assert len(per_task) == 8 and per_task.max() < 2 * per_task.mean() and pieces.where("start = 0").count() == len(rows)


def test_shares_join_like_a_plain_join_and_part_a_hot_key(spark):
    from veilframe.llm.common import with_shares

    rows = spark.range(4000).select("id", F.when(F.col("id") % 4 < 3, 0).otherwise(F.col("id") % 50).cast("long").alias("key"))
    facts = rows.groupBy("key").agg(F.count("*").alias("n"), F.max("id").alias("most")).where("key < 40")
    found = with_shares(rows, facts, "key", heavy=300)
    plain = rows.join(facts.drop("n"), "key").select(*found.columns)
    assert sorted(found.collect()) == sorted(plain.collect())
    assert found.where("key = 0").select(F.spark_partition_id()).distinct().count() > 1
    assert with_shares(rows.limit(0), facts, "key").count() == with_shares(rows, facts.limit(0), "key").count() == 0
