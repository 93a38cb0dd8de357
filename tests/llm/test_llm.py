"""Each operator against a brute-force version, a library or an exact round trip; nulls, empty and repeated rows, no rows."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from framesift.llm import queries
from framesift.llm.common import table
from framesift.llm.components import connected_components
from framesift.llm.decontam import leaks
from framesift.llm.licenses import inherited, scanned
from framesift.llm.mainhtml import cut, extracted, main_text
from framesift.llm.minhash import near_duplicates
from framesift.llm.packing import pack_counts, packed, pieces
from framesift.llm.tokencount import Transducer, count, pieces_of, token_counts
from framesift.llm.tokenfile import read_back, read_segment, segments, write_segment
from framesift.llm.tokenids import Encoder, vocabulary
from framesift.llm.toxicity import learn, scored, train
from framesift.llm.urlrep import judged
from framesift.llm.vectors import near_vectors

P = pytest.importorskip("public_tokenizers")
DOCS = "doc_id bigint, text string, component string, h string, part int, n int"  # clashing names
EDGE = [(1, "Hello there, world.  Two  spaces\nand lines", "x", "y", 1, 2), (2, None, None, None, None, None), (3, "", "", "", 0, 0), (3, "", "", "", 0, 0), (None, "no id at all", "", "", 0, 0), (5, "a" * 70_000, "", "", 0, 0), (6, "é ½ <|endoftext|> Σ  x\x00y", "", "", 0, 0)]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def shingles(t):
    w = words(t)
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def roots(nodes, links):
    lead = {v: v for v in nodes}

    def top(v):
        while lead[v] != v:
            v = lead[v]
        return v

    for a, b in links:
        a, b = top(a), top(b)
        lead[max(a, b)] = min(a, b)
    return {v: top(v) for v in nodes}


def test_components(spark):
    random.seed(2)
    e = [(random.randrange(300), random.randrange(300)) for _ in range(200)] + [(400 + i, 401 + i) for i in range(40)] + [(500, 500), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(e, "a bigint, b bigint")).collect()}
    real = [(a, b) for a, b in e if a is not None and a != b]
    assert got == roots({v for p in real for v in p}, real)
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_op1_pages(spark, sf_dir):
    import html

    pages = table(spark, sf_dir, "pages").collect()
    got = {r.page_id: r for r in queries.QUERIES["op1_html_extraction"](spark, sf_dir).collect()}
    for p in pages:
        inner = p.html.split("<article>")[1].split("</article>")[0].replace("<br>", " ")
        parts = (re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]+>", "", x))).strip() for x in re.split("</?(?:p|h1)>", inner))
        assert got[p.page_id].text == "\n\n".join(x for x in parts if x) and got[p.page_id].n_chars == len(got[p.page_id].text)


def test_op1_edges(spark):
    r = extracted(spark.createDataFrame([(1, None, None, "k"), (None, "u", "<article><p>One &amp; two.</p></article>", "k")], "page_id bigint, url string, html string, text string")).collect()
    assert [(v.page_id, v.text, v.n_chars) for v in r] == [(1, "", 0), (None, "One & two.", 10)]
    page = "<body><nav><a href=/>Home</a></nav><main><article><h1>T</h1><p>Body of the story.<br>More.</p><div class=ad>Buy!</div></article><section id=comments><p>I liked this long story very much, thank you.</p></section></main><form><label>Name</label></form><footer>&copy; x</footer><script>var a='<p>';</script>"
    assert main_text(page) == "T\n\nBody of the story. More."


def test_op1_skipped_elements():
    first, last = "<p>The first part of a story that is long enough.</p>", "<p>The last part of a story that is long enough.</p>"
    for inside in (
        "<noscript><p>Please enable JavaScript in your browser.</p></noscript>",
        "<button><span>Subscribe to all of our news</span> now</button>",
        "<select><option>The first of the choices</option><option>Two</option></select>",
        "<script>w('<div>Buy now, it is cheap</div>');x()</script>",
        "<script>if (a <b && c == '\"') y('<p>')</script>",
        "<textarea><b>Write</b> a remark about it here.</textarea>",
        "<template><template><p>One</p></template><p>Shown to nobody at all.</p></template>",
        "<svg><g><svg/><text>A label in a drawing</text></g></svg>",
    ):
        assert main_text(f"<article>{first}{inside}{last}</article>") == re.sub("<[^>]+>", "", first) + "\n\n" + re.sub("<[^>]+>", "", last), inside


def test_op1_unclosed_and_deep(spark):
    first, last = "The first part of a story that is long enough.", "The last part of a story that is long enough."
    for tag in ("object", "button", "select", "noscript", "svg", "template"):
        assert main_text(f"<article><p>{first}</p><{tag}><p>{last}</p></article>").endswith(last), tag
    assert main_text(f"<article><p>{first}</p><script>var a = 1; <p>{last}</p></article>") == first
    deep = "<div>" * 3000 + f"<article><p>{first}</p>" + "<i><b>" * 3000 + f"<p>{last}</p></article>"
    assert main_text(deep) == f"{first}\n\n{last}" and main_text("<p>" + "</i>" * 200_000 + first) == main_text("<p>" + first)
    long = "<article>" + f"<p>{first}</p>" * 20_000 + "</article>"
    got = extracted(spark.createDataFrame([(1, "u", long), (1, "u", long)], "page_id bigint, url string, html string")).collect()
    assert len(got) == 2 and all(r.n_chars == 20_000 * (len(first) + 2) - 2 for r in got)
    assert extracted(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_op1_cut_is_least():
    random.seed(1)
    for _ in range(200):
        n = random.randint(1, 7)
        odds = [random.choice([-3, -1, -0.5, 0.5, 1, 2]) + random.random() / 100 for _ in range(n)]
        edges = [(random.randrange(n), random.randrange(n), random.random() * 2) for _ in range(2 * n)]
        cost = lambda x: sum(abs(o) for o, v in zip(odds, x, strict=True) if (o > 0) != v) + sum(w for a, b, w in edges if x[a] != x[b])  # noqa: B023, E731
        best = min(cost([bool(k >> i & 1) for i in range(n)]) for k in range(1 << n))
        assert abs(cost(cut(odds, edges)) - best) < 1e-6


def test_op2(spark, sf_dir, edge, none):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    for r in queries.QUERIES["op2_token_counts"](spark, sf_dir).collect():
        assert (r.n_tokens, r.n_bytes) == (len(sp.encode(texts[r.doc_id])), len(texts[r.doc_id].encode()))
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(edge, P.path("piece_bpe_32k.model")).collect())
    assert got == sorted((d or 0, len((t or "").encode()), n := len(sp.encode(t or "")), n > 4096) for d, t, *_ in EDGE)
    assert token_counts(none, P.path("piece_bpe_32k.model")).count() == 0
    with open(P.path("piece_bpe_32k.model"), "rb") as f:
        machine = Transducer(pieces_of(f.read()))
    machine.MOST_STATES = 500
    random.seed(1)
    for _ in range(1500):
        s = "".join(random.choice("ab  ▁e\n\t.,é中\U0001f600tThing<s>") for _ in range(random.randint(0, 30)))
        assert count(machine, s, 3) == count(machine, s) == len(sp.encode(s))


def test_op3(spark):
    item = "If Alice buys 12 apples for 3.5 dollars each and Bob sells 7 pears to Alice, how many dollars are left now for Alice?"
    bench = spark.createDataFrame([(1, item, "x"), (2, None, ""), (3, "short one", ""), (None, item, "")], "item_id bigint, text string, h string")
    other = "if carol buys 40 apples for 9 dollars each and dave sells 8 pears to carol, how many dollars are left now for carol?"
    docs = [(1, "Before. " + item + " After that"), (2, "so " + other), (3, other.replace("to carol", "to erin").replace("carol", "Carol").replace("erin", "Erin").replace("dave", "Dave")), (4, None), (5, ""), (6, "nothing like it at all in this text, really nothing"), (1, item), (None, item)]
    got = {r.doc_id: r.n_changed for r in leaks(spark.createDataFrame([(*d, "z") for d in docs], "doc_id bigint, text string, k string"), bench).collect()}
    assert got == {1: 0, 2: 3}
    assert leaks(spark.createDataFrame([], DOCS), bench).count() == 0


def test_op3_short_runs(spark):
    items = {1: "seven wonders lie beyond rivers", 2: "What is 7 + 5?", 3: "where do old maps end now", 4: "red green blue white black brown amber coral olive ivory khaki lilac mauve ochre pearl peach plum rose", 5: "42", 6: "tell me why"}
    edited = items[4].split()
    edited[5] = edited[11] = edited[17] = "grey"  # runs of five words
    texts = {1: items[1], 2: "asked: what is 9 + 4, then", 3: items[3], 4: " ".join(edited), 5: "it was 42 then", 6: "please tell me why"}
    bench = spark.createDataFrame(list(items.items()), "item_id bigint, text string")
    docs = [(k * 10 + at, "w " * at + text) for k, text in texts.items() for at in range(8)] + [(99, "it was 43 then; tell me"), (98, "")]
    got = {(r.doc_id, r.item_id) for r in leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), bench).collect()}
    assert got == {(k * 10 + at, k) for k in texts for at in range(8)}


def test_op3_names_without_case(spark):
    item = "today, Alice, Bob and Carol met Dave in Boston, Erin paid Frank 12 dollars and Grace, Heidi saw Ivan"
    copies = [item, item.lower(), item.upper(), item.lower().replace("12", "40"), item.upper().replace("12", "40")]
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    docs = [(k, "w " * k + text) for k, text in enumerate(copies)] + [(9, "today, nobody met anybody in town and nobody paid")]
    got = {r.doc_id: r.n_changed for r in leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), bench).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 1, 4: 1}


def test_op3_numbers_alone(spark, monkeypatch):
    """Tables of numbers meet items of numbers only with the same values; changed values are found beside words."""
    from framesift.llm import decontam

    random.seed(5)
    numbers = [str(random.randrange(10**6)) for _ in range(60)]
    items = {1: " ".join(numbers), 2: "the sum of the numbers " + " ".join(numbers[:10] + numbers[50:40:-1]) + " is asked for here"}
    hits = []
    monkeypatch.setattr(decontam, "written", lambda df, what: (hits.append(df.count()) if what == "leak-hits" else None, df)[1])
    other = " ".join(str(random.randrange(10**6)) for _ in range(3000))
    docs = {1: other, 2: "see " + items[1] + " there", 3: items[2].replace(numbers[3], "5").replace(numbers[7], "6"), 4: "so " + items[2], 5: "lorem ipsum " * 20_000 + items[2]}
    bench = spark.createDataFrame(list(items.items()), "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): r.n_changed for r in leaks(spark.createDataFrame(list(docs.items()), "doc_id bigint, text string"), bench).collect()}
    assert got == {(2, 1): 0, (3, 2): 2, (4, 2): 0, (5, 2): 0} and hits == [6]  # two copies share numbers with the item of numbers; the long table shares nothing


def test_op3_finds_every_copy(spark, sf_dir):
    docs, bench = table(spark, sf_dir, "documents").collect(), table(spark, sf_dir, "benchmark").collect()
    flat = lambda t: " " + " ".join(re.findall(r"[^\W_]+", t.lower())) + " "
    want = {(d.doc_id, b.item_id) for d in docs for b in bench if flat(b.text) in flat(d.text)}
    got = {(r.doc_id, r.item_id) for r in queries.QUERIES["op3_benchmark_decontamination"](spark, sf_dir).collect()}
    assert got == want


def test_op4(spark, edge, none):
    d = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in table(spark, d, "labels").collect()}
    rows = [r for r in queries.QUERIES["op4_toxicity"](spark, d).collect()]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    hit = sum(labels[r.doc_id] and r.predicted for r in held)
    assert hit > 0.85 * sum(labels[r.doc_id] for r in held) and hit > 0.9 * sum(r.predicted for r in held)
    toy = {"bias": -2.0, "share": 0.5, "weights": {"=bad": 3.0, "^wor": 1.5, "rse$": 0.25}}
    odds = lambda *z: 1 - np.prod([1 - 1 / (1 + np.exp(-v)) for v in z])
    texts = {1: ("It is bad! Worse, bad. Fine", odds(1.0, 2.75, -2.0)), 2: ("fine", odds(-2.0)), 3: ("BAD bad", odds(4.0)), 4: ("", 0.0), 5: ("bad. " * 3000, 1.0)}  # noisy-or over sentences by hand
    got = {r.doc_id: r for r in scored(spark.createDataFrame([(k, t) for k, (t, _) in texts.items()], "doc_id bigint, text string"), toy).collect()}
    assert all(abs(got[k].score - p) < 1e-9 for k, (_, p) in texts.items()) and [(v.start, v.stop) for v in got[1].offending] == [(10, 22), (0, 10)]
    model = learn(["you idiot. fine day", "good day. nice"] * 20, [1, 0] * 20)
    assert scored(edge, model).count() == len(EDGE) and scored(none, model).count() == 0
    assert train(none, spark.createDataFrame([], "doc_id bigint, toxic int"))["share"] == 0.0


def test_op5(spark):
    urls = [(1, "http://WWW.Example.com/en/1?q"), (2, "https://example.com/en/"), (3, "http://example.com/de"), (4, "x.net/es/"), (5, None), (6, "ftp://a.net/es/x#y"), (7, "http://com"), (8, "://com/"), (8, "://com/")]
    r = judged(spark.createDataFrame([(*u, "h") for u in urls], "page_id bigint, url string, host string"), spark.createDataFrame([(1, 1), (None, 1), (2, None)], "page_id bigint, bad int")).collect()
    got = {v.page_id: (v.host, v.path, v.rule, v.verdict) for v in r}
    assert len(r) == len(urls) and got[1] == ("www.example.com", "/en/1", "www.example.com/en/", "allow") and got[2] == ("example.com", "/en/", "example.com/en/", "block")
    assert got[3][2] == "com/" and got[4][:3] == ("", "", None) and got[5][:3] == ("", "", None) and got[6][2:] == ("net/es/", "block") and got[7][:3] == ("com", "", None) and got[8][2] == "com/"
    assert judged(spark.createDataFrame([], "page_id bigint, url string"), spark.createDataFrame([(1, 1)], "page_id bigint, bad int")).count() == 0
    hosts = ["a.b.co.uk", "b.co.uk", "co.uk", "x.y.com", "com", "", "10.0.0.1", "10.0.0.1:80", "a.net:8080", "[::1]", "a.co.com"]
    from framesift.llm.urlrep import registered

    x = spark.createDataFrame([(h,) for h in hosts], "host string").select("host", *[c.alias(n) for n, c in zip(("d", "s"), registered(F.col("host")), strict=True)])
    assert [(v.d, v.s) for v in x.collect()] == [("b.co.uk", "co.uk"), ("b.co.uk", "co.uk"), ("co.uk", "co.uk"), ("y.com", "com"), ("com", "com"), ("", ""), ("10.0.0.1", "ip"), ("10.0.0.1", "ip"), ("a.net", "net"), ("[::1]", "ip"), ("co.com", "com")]
    many = [(i, f"http://bad.org/{i}") for i in range(60)] + [(100 + i, f"http://h{i % 40}.net/a") for i in range(400)]
    r = judged(spark.createDataFrame(many, "page_id bigint, url string"), spark.createDataFrame([(i, int(i < 60)) for i, _ in many], "page_id bigint, bad int"))
    assert {v.host for v in r.where("verdict = 'block'").collect()} == {"bad.org"}


def near_brute(rows):
    sets = {d: shingles(t) for d, t in rows}
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    return sets, roots(ids, links)


def test_op6(spark, edge, none):
    random.seed(4)
    vocab = [f"w{i}" for i in range(200)]
    base = [[random.choice(vocab) for _ in range(random.choice([3, 5, 40, 120]))] for _ in range(25)]
    rows = []
    for i in range(260):
        w = list(base[i % 25])
        for _ in range(random.randrange(0, 1 + len(w) // 18)):
            w[random.randrange(len(w))] = random.choice(vocab)
        rows.append((i, (" ", "  \n")[i % 2].join(w).title() if i % 3 else " ".join(w)))
    sets, want = near_brute(rows)
    got = {r.doc_id: r for r in near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert {d: r.component_id for d, r in got.items()} == want and {d: r.n_shingles for d, r in got.items()} == {d: len(s) for d, s in sets.items()}
    assert all(r.kept == (r.component_id == d) for d, r in got.items())
    r = near_duplicates(edge).collect()
    assert len(r) == len(EDGE) and [v.n_shingles for v in r if v.doc_id in (2, 3)] == [0, 0, 0] and [v.component_id for v in r if v.doc_id is None] == [None] and all(v.kept for v in r)
    assert near_duplicates(none).count() == 0


def test_op7(spark):
    rows = [(1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/x.txt", "Some text without."), (3, "a/c/y.txt", "code\n\nLicensed under CC BY-NC 4.0.\n" + "text " * 400), (4, "z/q.txt", None), (5, None, ""), (6, "a/b/LICENSE", "This work is licensed under the GNU General Public License, version 3."), (7, "ab/x", "a license is a word here")]
    x = scanned(spark.createDataFrame([(*r, "k") for r in rows], "doc_id bigint, path string, text string, dir string"))
    got = {r.doc_id: (r.license, r.final_license, r.inherited_from) for r in inherited(x).collect()}
    assert got == {1: ("MIT", "MIT", "a"), 2: (None, "GPL-3.0", "a/b"), 3: ("CC-BY-NC-4.0", "CC-BY-NC-4.0", "a"), 4: (None, None, None), 5: (None, None, None), 6: ("GPL-3.0", "GPL-3.0", "a/b"), 7: (None, None, None)}
    assert inherited(scanned(spark.createDataFrame([], "doc_id bigint, path string, text string"))).count() == 0


def test_op7_counts_the_terms_it_weighs(spark):
    from framesift.llm.licenses import term_counts

    n, counts = term_counts(spark.createDataFrame([("(the software: by-nc, 4.0)",), ("Version 2.0",), (None,)], "text string"))
    assert n == 3 and counts == {t: 1 for t in ("the", "software", "by", "nc", "4.0", "version", "2.0")}


def test_op7_full_texts_and_headers(spark):
    from framesift.llm.licenses import TEMPLATES

    full = {k.split("/")[0]: t for k, t in TEMPLATES.items() if k.endswith("/text")}
    mit = "\n".join(" * " + x for x in full["MIT"].split("\n"))
    code = "".join(f"int f{k}(int a) {{ return a + {k}; }}\n" for k in range(2000))
    rows = [(k, f"d{k}/LICENSE", t, name, True) for k, (name, t) in enumerate(sorted(full.items()))]
    rows += [
        (50, "a/x.c", f"/*\n{mit}\n */\n{code}", "MIT", False),
        (51, "b/x.c", "/*\n * This program is free software; you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n * the Free Software Foundation; either version 2 of the License, or\n * (at your option) any later version.\n */\n" + code, "GPL-2.0", False),
        (52, "c/x.c", code + full["Apache-2.0"] + code, "Apache-2.0", False),
        (53, "e/LICENSE", full["GPL-3.0"] + "\n" * 5 + full["GPL-3.0"], "GPL-3.0", True),
        (54, "f/x.txt", "Licensed under CC BY-NC-SA 3.0.\n" + code, "CC-BY-NC-SA-3.0", False),
        (55, "g/x.txt", code, None, False),
    ]
    x = scanned(spark.createDataFrame([r[:3] for r in rows], "doc_id bigint, path string, text string"))
    assert {r.doc_id: (r.license, r.is_license_file) for r in x.collect()} == {r[0]: r[3:] for r in rows}


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_token_ids(name, spark, sf_dir):
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(P.path(name)), Encoder(vocabulary(P.path(name)))
    random.seed(3)
    bits = ["a", "B", "é", " ", "  ", "\n", "\t", "<|endoftext|>", "'s", "12", ".", " ", "Σ", "́", "中", "!!", "\r\n", "½", "_", "İ", "\x00", "\x1c", "hello", "'"]
    texts = ["".join(random.choice(bits) for _ in range(random.randint(0, 12))) for _ in range(3000)] + [r.text for r in table(spark, sf_dir, "documents").collect()]
    bits += ["'re", "'LL", "''s", "('s", "'d'", "don't", "日本", "Привет", "😀", "ﬁ", "K", "ª", "٣", "’s", "__a", "x" * 30]
    texts += ["".join(random.choice(bits) for _ in range(random.randint(0, 12))) for _ in range(3000)] + [None, "", "'", "'s", "'r", "ab " * 100_000, "a" * 300_000]
    for t, ids in zip(texts, own.many(texts), strict=True):
        assert ids.tolist() == library.encode(t or "", add_special_tokens=False).ids, repr(t)
    for t in texts:
        assert own.ids(t).tolist() == library.encode(t or "", add_special_tokens=False).ids, repr(t)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_token_ids_of_long_runs(name):
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(P.path(name)), Encoder(vocabulary(P.path(name)))
    runs = [" " * 1_000_000, " " * 3_000_000, "\n" * 3_000_000, " \n\t" * 20_000, " " * 49_999, "a" * 1_000_000, "7" * 200_000, "!" * 200_000, "中" * 200_000]
    for t in [f"word {r}a" for r in runs] + [runs[1], " x" * 400_000]:
        assert np.array_equal(own.ids(t), library.encode(t, add_special_tokens=False).ids), (t[5:9], len(t))


def test_word_table_fills_up(monkeypatch):
    """A table that is full is emptied; words that want one slot all find a place."""
    from framesift.llm import wordids

    monkeypatch.setattr(wordids, "CHUNK", 256)
    own = Encoder(vocabulary(P.path("word_bpe_49k.json")))
    own.many([])
    table, emptied = own.table, []
    empty = table._empty
    monkeypatch.setattr(table, "_empty", lambda: (emptied.append(table.words), empty()))
    table.words = wordids.SLOTS // 2 - 300
    value = table.value
    table.value = value >> np.uint64(40)  # hashes that lie close together, so that many want one slot
    texts = ["cab", "the cab bac"] * 3
    table.value, kept = np.ones_like(value), table.value  # words of one length and one hash are told apart by their letters
    assert [x.tolist() for x in own.many(texts)] == [own.ids(t).tolist() for t in texts]
    empty()
    table.words, table.value = wordids.SLOTS // 2 - 300, kept
    texts = [" ".join("".join(random.choices("abcdefghijklmnop", k=3)) for _ in range(20)) for _ in range(400)]
    assert [x.tolist() for x in own.many(texts)] == [own.ids(t).tolist() for t in texts] and emptied


def test_op8(spark, sf_dir, edge, none):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    for _ in range(200):
        c = {random.randint(1, 64): random.randint(0, 9) for _ in range(random.randint(0, 30))}
        got: dict = {}
        for _, n, items in pack_counts(c, 64):
            assert n > 0 and sum(a * b for a, b in items) <= 64
            for a, b in items:
                got[a] = got.get(a, 0) + n * b
        assert got == {k: v for k, v in c.items() if v}
    for docs in (table(spark, sf_dir, "documents").select("doc_id", "text"), edge.select("doc_id", "text")):
        r = packed(pieces(docs, P.path("byte_bpe_50k.json"))).toPandas()
        ids = {d: np.array(tk.encode(t or "", add_special_tokens=False).ids + [0], "<u4") for d, t in docs.collect()}
        for v in r.itertuples():
            x = ids[None if np.isnan(v.doc_id) else int(v.doc_id)][v.start : v.start + v.length]
            assert len(x) == v.length and zlib.crc32(x.tobytes()) == v.ids_crc32
        assert r.length.sum() == sum(len(ids[d]) for d, _ in docs.collect())
        r = r.sort_values(["sequence_id", "offset"])
        assert (r.offset == (r.offset + r.length).groupby(r.sequence_id).shift().fillna(0)).all() and (r.offset + r.length).max() <= 2048
    assert packed(pieces(none, P.path("byte_bpe_50k.json"))).count() == 0


def test_op9(spark, sf_dir, edge, none):
    from tokenizers import Tokenizer

    rng = np.random.default_rng(1)
    for n, high, block in ((0, 10, 16), (1, 1, 16), (1000, 3, 16), (5000, 49408, 256), (3000, 2**32, 100)):
        x = rng.integers(0, high, n).astype(np.uint32)
        data = write_segment(np.array([7]), np.array([False]), np.array([n]), x, block)
        assert (read_segment(data)[3] == x).all()
        if n > 100:
            broken = bytearray(data)
            broken[-20] ^= 1
            with pytest.raises(ValueError):
                read_segment(bytes(broken))
    skewed = np.minimum(rng.geometric(0.01, 40_000), 5000).astype(np.uint32)  # fewer bytes than the entropy of order 0 where contexts tell more
    skewed[1::2] = skewed[::2] + 1
    share = np.bincount(skewed)[np.unique(skewed)] / len(skewed)
    assert len(write_segment(np.array([7]), np.array([False]), np.array([40_000]), skewed, 4096)) < -(share * np.log2(share)).sum() / 8 * 40_000
    tk = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    for docs in (table(spark, sf_dir, "documents"), edge):
        files = segments(docs, P.path("word_bpe_49k.json"), 2, segment=3000)
        got = sorted(((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in read_back(files).collect()), key=lambda v: v[0])
        rows = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda v: (v[0] is not None, v[0]))
        at = 0
        for (start, doc_id, n, crc), (d, t) in zip(got, rows, strict=True):
            x = np.array(tk.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
            assert (start, doc_id, n, crc) == (at, d, len(x), zlib.crc32(x.tobytes()))
            at += n
    assert read_back(segments(none, P.path("word_bpe_49k.json"), 2)).count() == 0


def test_op10(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 16))
    for i in range(600):
        x[900 + i] = x[i % 37] + rng.normal(size=16) * 0.08
    x[10] = x[11]
    v = x.tolist()
    rows = [(i, r, 0) for i, r in enumerate(v)] + [(2000, None, 0), (2001, [0.0] * 16, 0), (2002, [float("nan")] * 16, 0), (2003, [None, *v[0][1:]], 0), (2004, v[0][:8], 0), (2005, v[0][:8], 0), (None, v[0], 0), (5, v[5], 0)]
    got = {}
    out = near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, other int")).collect()
    for r in out:
        got[r.vec_id] = r
    u = x / np.sqrt((x * x).sum(1))[:, None]
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    links = np.array([got[i].n_links for i in range(1500)])
    assert len(out) == len(rows) and (links == near.sum(1)).all() and near.sum() > 1000
    want = roots(range(1500), [(int(a), int(b)) for a, b in np.argwhere(near)])
    assert all(got[i].component_id == want[i] for i in range(1500)) and [got[i].n_links for i in (2004, 2005)] == [1, 1] and got[2005].component_id == 2004
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in (2000, 2001, 2002, 2003))
    assert near_vectors(spark.createDataFrame([], "vec_id bigint, embedding array<double>")).count() == 0


def test_op10_cells_and_audit(spark, monkeypatch):
    """Cells in cells, shards in blocks; a search that finds too little is widened until the audit is content."""
    from framesift.llm import vectors

    monkeypatch.setattr(vectors, "LARGEST", 300), monkeypatch.setattr(vectors, "BLOCK", 120), monkeypatch.setattr(vectors, "SHARD", 100), monkeypatch.setattr(vectors, "CHILDREN", 16)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1600, 12))
    x[1000:] = x[rng.integers(0, 60, 600)] + rng.normal(size=(600, 12)) * 0.06
    x[1500:] = x[0] + rng.normal(size=(100, 12)) * 0.01
    u = x / np.sqrt((x * x).sum(1))[:, None]
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(x.tolist())], "vec_id bigint, embedding array<double>")
    widths, real = [], vectors.links
    monkeypatch.setattr(vectors, "links", lambda groups, adjacency, wider=1: (widths.append(wider), real(groups, adjacency, wider) if wider > 1 else real(groups, adjacency, wider).limit(0))[1])
    got = {r.vec_id: r.n_links for r in near_vectors(frame).collect()}
    assert widths == [1, 2] and sum(got.values()) >= 0.99 * near.sum() and all(got[i] <= n for i, n in enumerate(near.sum(1)))


def test_op8_number_of_sequences():
    """As few bins as an exact search finds, for small cases; never more than one above the bound for many items."""
    random.seed(9)

    def fewest(items, capacity):
        best = len(items)

        def place(k, bins):
            nonlocal best
            if len(bins) >= best:
                return
            if k == len(items):
                best = len(bins)
                return
            for i in range(len(bins)):
                if bins[i] + items[k] <= capacity and bins[i] not in bins[:i]:
                    bins[i] += items[k]
                    place(k + 1, bins)
                    bins[i] -= items[k]
            place(k + 1, [*bins, items[k]])

        place(0, [])
        return best

    total = {0: 0, 1: 0}
    for _ in range(150):
        items = sorted((random.randint(1, 30) for _ in range(random.randint(1, 9))), reverse=True)
        got = sum(n for _, n, _ in pack_counts({v: items.count(v) for v in items}, 30))
        total[got - fewest(items, 30)] += 1  # a KeyError if it takes two more
    assert total[0] > 140
    many = {random.randint(1, 2048): random.randint(1, 40) for _ in range(600)}
    assert sum(n for _, n, _ in pack_counts(many)) <= 1.02 * max(sum(k * v for k, v in many.items()) / 2048, sum(v for k, v in many.items() if k > 1024))


def test_pipeline_edges(spark, sf_dir, edge, none):
    """Null ids, repeated rows, empty and long texts, clashing columns, no rows: each stage keeps the columns and the clean rows."""
    import corpus_pipeline as cp

    rows = lambda x: sorted(map(str, x.collect()))
    for name, stage in cp.STAGES[:-1]:
        got = stage(spark, edge, sf_dir)
        assert got.schema == edge.schema and rows(got) == rows(edge), name
        assert stage(spark, none, sf_dir).columns == none.columns and stage(spark, none, sf_dir).count() == 0
    twice = edge.unionByName(edge).unionByName(spark.createDataFrame([(9, EDGE[0][1].upper(), "", "", 0, 0)], DOCS))
    assert rows(cp.near_dedup(spark, twice, sf_dir)) == rows(edge.unionByName(edge))
    packed_ = cp.packing(spark, edge, sf_dir).collect()
    assert len({(r.sequence_id, r.offset) for r in packed_}) == len(packed_) > len(EDGE) and cp.packing(spark, none, sf_dir).count() == 0


def test_op7_cosine_by_brute_force(spark):
    """Each part's best template is that of the largest cosine, term by term; licences come from the nearest directory."""
    import math

    from framesift.llm.licenses import TEMPLATES, Matcher, terms

    counts = {"the": 90, "license": 20, "software": 30, "mit": 2, "apache": 3}
    m = Matcher(100, counts)
    vector = lambda t: {w: (1 + math.log(c)) * math.log(102 / (1 + counts.get(w, 0))) for w, c in terms(t).items()}
    size = lambda v: math.sqrt(sum(x * x for x in v.values()))
    for t in [*TEMPLATES.values(), "the software is under the apache license", "mit license the the software", "nothing of it"]:
        v = vector(t)
        want = max((sum(x * vector(u).get(w, 0.0) for w, x in v.items()) / (size(v) * size(vector(u))), name) for name, u in TEMPLATES.items())
        score, name = m.best(terms(t))
        assert abs(score - want[0]) < 1e-9 and (name == want[1] or abs(score) < 1e-9 or abs(score - want[0]) < 1e-9)
    random.seed(3)
    paths = ["/".join(random.choice("abc") for _ in range(random.randint(0, 4))) for _ in range(150)]
    rows = [(k, f"{p}/f{k}" if p else f"f{k}", random.choice(["MIT", "GPL-3.0"]) if (lic := random.random() < 0.15) else None, random.choice([0.7, 0.9]) if lic else 0.0, lic) for k, p in enumerate(paths)]
    own: dict = {}
    for k, path, name, score, lic in rows:
        if lic:
            d = path.rpartition("/")[0]
            own[d] = min(own.get(d, (0.0, "", "")), (-score, path, name)) if d in own else (-score, path, name)
    got = {r.doc_id: (r.inherited_license, r.inherited_from) for r in inherited(spark.createDataFrame(rows, "doc_id bigint, path string, license string, score double, is_license_file boolean")).collect()}
    for k, path, *_ in rows:
        at = path.rpartition("/")[0].split("/") if "/" in path else []
        above = next((d for n in range(len(at), -1, -1) if (d := "/".join(at[:n])) in own), None)
        assert got[k] == ((own[above][2], above) if above is not None else (None, None))


def test_pipeline(spark, sf_dir):
    import corpus_pipeline as cp

    docs = table(spark, sf_dir, "documents")
    before = docs
    for k, (name, stage) in enumerate(cp.STAGES[:-1]):
        after = stage(spark, docs, sf_dir)
        assert after.columns == before.columns
        kept = {r.doc_id for r in after.collect()}
        if name == "near_dedup":
            _, want = near_brute([(r.doc_id, r.text) for r in docs.collect()])
            assert kept == set(want.values())
        if name == "decontamination":
            gone = {r.doc_id for r in leaks(docs, table(spark, sf_dir, "benchmark")).collect()}
            assert kept == {r.doc_id for r in docs.collect()} - gone
        docs = spark.createDataFrame(after.collect(), before.schema)
    assert {r.doc_id for r in cp.run(spark, sf_dir).collect()} == kept
