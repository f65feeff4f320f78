"""The llm operators against plain versions, on small and on awkward inputs."""

import random
import textwrap
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import brute
from tessera.llm import anchors, decontam, jaccard, license_scan, linededup, pieces, suffixarray, suffixtree, topk, toxicity, urlfilter
from tessera.llm.common import spread
from tessera.llm.components import components
from tessera.llm.queries import default_model
from tessera.llm.wordcore import LOWER, SAME, SPACE, Words, column_bytes, window_hashes

DDL = "doc_id long, text string, lang string, h1 string, bucket string, t string"


def docs_of(spark, rows, parts=3):
    """Documents with extra columns whose names clash with those inside the operators."""
    return spark.createDataFrame([(d, t, "en", "x", "y", "z") for d, t in rows], DDL).repartition(parts)


def corpus(seed=5, n=60):
    """Texts with shared passages, copies, near copies, repeated lines, nulls, empty and long ones."""
    r = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["é", "ß中", "The", "THE", "x" * 90]
    text = lambda k: "".join(r.choice(words) + r.choice([" ", " ", " ", "\n", "\t", ", "]) for _ in range(k))
    passage, line = text(80), "A line that comes back again and again"
    out = [(0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "one"), (5, "\n".join([line] * 3)), (6, "a" * 700), (7, "ab" * 400), (8, text(2000))]
    for i in range(9, n):
        t = text(r.choice([3, 30, 60, 200]))
        if i % 4 == 0:
            t += passage + text(20)
        if i % 5 == 0:
            t = f"{line}\n  {line.upper()} \n{t}"
        if i % 7 == 0:
            t = out[-1][1]
        if i % 9 == 0:
            w = out[8][1].split(" ")
            w[i * 3] = "changed"
            t = " ".join(w)
        out.append((i, t))
    return out


@pytest.fixture(scope="module")
def rows():
    return corpus()


ITEMS = [(1, "w1 w2"), (10, None), (2, ""), (3, "!!"), (9, "THE one"), (11, "one")]


@pytest.mark.parametrize("block", [decontam.BLOCK_BYTES, 400])
def test_decontamination(spark, rows, block):
    items = [*ITEMS, *((100 + i, t) for i, t in rows[8:40:6]), (100, rows[8][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.digest(decontam.matches(docs_of(spark, rows), bench, block_bytes=block)).collect()
    assert sorted(map(tuple, got)) == sorted(brute.decontamination(rows, items))


def test_decontamination_many_short_items(spark):
    """Equal windows of many items, items without an id, and one common word: candidates are made in slices."""
    items = [(i, "the") for i in range(10_000)] + [(None, "red green"), (None, "the"), (20_000, "the red"), (20_000, "the red")]
    rows = [(1, "the red green " * 300), (2, "green red"), (3, "red green"), (4, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (decontam.BLOCK_BYTES, 2000):
        got = decontam.digest(decontam.matches(docs_of(spark, rows), bench, block_bytes=block)).collect()
        assert sorted(map(tuple, got)) == sorted(brute.decontamination(rows, items))


def test_decontamination_slices(rows, monkeypatch):
    monkeypatch.setattr(decontam, "_CANDIDATES", 7)
    import pyarrow as pa

    data, offsets = column_bytes(pa.array([t for _, t in rows], pa.string()))
    words = Words(data, offsets, LOWER, decontam.SEPARATORS)
    windows = decontam.Windows([(i, t) for i, t in rows[8:30:4]] + ITEMS, 10)
    few = decontam.Shard(words, windows.vocabulary).match(windows)
    monkeypatch.undo()
    assert sorted(zip(*map(list, few), strict=True)) == sorted(zip(*map(list, decontam.Shard(words, windows.vocabulary).match(windows)), strict=True))


def twins(bits=12):
    """Two different strings of 2**bits letters, each the other's complement, which agree in every polynomial hash modulo 2**64."""
    x = [bin(i).count("1") % 2 for i in range(1 << bits)]
    return "".join("ab"[k] for k in x), "".join("ba"[k] for k in x)


def test_patterned_words_are_told_apart(spark):
    """op1, op3, op8, op10, op2 on strings that collide in polynomial hashes, as words, as lines and as sequences of words."""
    a, b = twins()
    filler = " ".join(f"f{i}" for i in range(60))
    bench = spark.createDataFrame([(1, a)], "item_id long, text string")
    rows = [(1, a), (2, b), (3, f"x {a} y"), (4, f"x {b} y")]
    got = decontam.digest(decontam.matches(docs_of(spark, rows), bench)).collect()
    assert sorted(map(tuple, got)) == sorted(brute.decontamination(rows, [(1, a)]))
    rows = [(i, [a, b][i % 2] + f"\nown {i}") for i in range(5)]
    assert sorted(map(tuple, linededup.digest(docs_of(spark, rows)).collect())) == sorted(brute.line_dedup(rows))
    p, q = filler.split(), filler.split()
    p[30], q[30] = a, b
    words = [" ".join({"a": "alpha", "b": "beta"}[c] for c in t) for t in (a, b)]
    rows = [(1, " ".join(p)), (2, " ".join(q)), (3, words[0]), (4, words[1])]
    assert sorted(tuple(r)[:4] for r in suffixtree.remove(docs_of(spark, rows)).collect()) == sorted(brute.passages(rows, 50))
    rows = [(1, f"u v {a} w"), (2, f"u v {b} w"), (3, a), (4, b), (5, words[0]), (6, words[1])]
    assert sorted(map(tuple, jaccard.join(docs_of(spark, rows)).collect())) == sorted(brute.similar(rows))
    rows = [(1, a), (2, b), (3, filler * 3 + a[:512]), (4, filler[::-1] + b[:512])]
    assert sorted(tuple(r)[:5] for r in suffixarray.remove(docs_of(spark, rows)).collect()) == sorted(brute.substrings(rows, 400))


def test_buckets_fill_partitions_evenly(spark):
    """Two buckets for each partition of Spark's own hash."""
    for n in (1, 4, 51, 211):
        ids = spark.createDataFrame([(int(i),) for i in spread(2 * n)], "i int")
        assert {r.n for r in ids.groupBy(F.pmod(F.hash("i"), F.lit(n)).alias("p")).agg(F.count("*").alias("n")).collect()} == {2} and len(set(spread(2 * n).tolist())) == 2 * n


def test_word_hashes():
    """Equal just for equal words: lengths around eight bytes, zero bytes, patterns, and windows of any width."""
    import numpy as np
    import pyarrow as pa

    r = random.Random(11)
    words = {"".join(r.choice("ab") for _ in range(r.randint(1, 80))) for _ in range(5000)} | {"a" * n for n in range(1, 200)} | {"\x00" * n for n in range(1, 20)} | {"a" + "\x00" * n for n in range(20)} | set(twins())
    words = sorted(words)
    data, offsets = column_bytes(pa.array([" ".join(words + words)]))
    h = Words(data, offsets, SAME, SPACE).hashes()
    n = len(words)
    assert (h[:n] == h[n:]).all() and len(np.unique(h)) == n and not (Words(data, offsets, SAME, SPACE).hashes(5) == h).any()
    for width in (1, 2, 3, 5, 7, 10, 50):
        seq = h[np.array([r.randrange(2) for _ in range(3000)])]
        w = window_hashes(seq, width)
        assert len(w) == len(seq) - width + 1
        seen = {}
        for i in range(len(w)):
            assert seen.setdefault(tuple(seq[i : i + width]), w[i]) == w[i]
        assert len(set(seen.values())) == len(seen)


def test_suffix_array_rows_without_id(spark):
    """Rows without an id repeat what others hold, and lose it themselves."""
    r = random.Random(12)
    shared = "".join(r.choice("abcdefghij") for _ in range(900))
    rows = [(None, "copy " * 200), (None, "copy " * 200), (5, "five " + shared + " tail"), (None, "none " + shared[4:895] + " end"), (None, None), (None, "short")]
    got = [tuple(r)[:5] for r in suffixarray.remove(docs_of(spark, rows)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, brute.substrings(rows, 400)))
    assert {r[2] for r in got if r[0] == 5} == {891}


@pytest.mark.parametrize("copies", [2, 3, 5])
def test_line_decider(copies):
    """Batches of any size, keys that begin or end a partition, and a key of all records."""
    import numpy as np

    r = random.Random(copies)
    for _ in range(150):
        rows = sorted((r.choice([1, 1, 1, 2, 3]), 0, r.randrange(8), r.randrange(2), r.randrange(6)) for _ in range(r.randint(1, 60)))
        decider, at, dropped, undecided = linededup.Decider(copies), 0, [], []
        while at < len(rows):
            k = r.randint(1, 9)
            drop, first = decider.add(*[np.array(c, np.int64) for c in zip(*rows[at : at + k], strict=True)])
            dropped += zip(*[c.tolist() for c in drop], strict=True)
            undecided += zip(*[c.tolist() for c in first], strict=True)
            at += k
        undecided += zip(*[c.tolist() for c in decider.held], strict=True)
        docs = {}
        for x in rows:
            docs.setdefault(x[0], set()).add(x[2])
        ends = {rows[0][0], rows[-1][0]}
        assert {k: sorted(v)[-copies:] for k, v in docs.items() if k in ends} == {k[0]: v for k, v in decider.tops.items()}
        late = [x for x in undecided if len(docs[x[0]]) >= copies and x[2] != max(docs[x[0]])]
        assert sorted(dropped + late) == [x for x in rows if len(docs[x[0]]) >= copies and x[2] != max(docs[x[0]])]
        assert {x[0] for x in undecided} <= ends


def test_decontamination_proximity(spark):
    bench = spark.createDataFrame([(1, "red green blue")], "item_id long, text string")
    docs = docs_of(spark, [(1, "red green blue"), (2, "red so green blue"), (3, "blue x x x green red"), (4, "red green x x x x blue")])
    hits = lambda slop: {r.doc_id for r in decontam.matches(docs, bench, slop=slop).where("size(starts) > 0").collect()}
    assert hits(0) == {1} and hits(1) == {1, 2}


def test_line_dedup(spark, rows):
    got = linededup.digest(docs_of(spark, rows)).collect()
    assert sorted(map(tuple, got)) == sorted(brute.line_dedup(rows))


def test_line_dedup_hot_line_over_partitions(spark):
    rows = [(i, "the same line in every document\nown line of this document %03d" % i) for i in range(400)]
    got = linededup.digest(docs_of(spark, rows, 8)).collect()
    assert sorted(map(tuple, got)) == sorted(brute.line_dedup(rows))


def test_line_dedup_keeps_columns(spark, rows):
    got = linededup.dedup(docs_of(spark, rows))
    assert got.columns == ["doc_id", "text", "lang", "h1", "bucket", "t"] and got.count() == len(rows)
    texts = {r.doc_id: r.text for r in got.collect()}
    assert texts[0] is None and {d: brute.sha(t or "") for d, t in texts.items()} == {d: s for d, _, _, s in brute.line_dedup(rows)}


@pytest.mark.parametrize(("limits", "runs"), [({}, None), ({"shard_bytes": 3000, "cross_bytes": 300}, None), ({"shard_bytes": 3000, "cross_bytes": 300}, 1), ({}, 0)])
def test_suffix_array(spark, rows, limits, runs, monkeypatch):
    if runs is not None:
        monkeypatch.setattr(anchors, "MOST_RUNS", runs)
    plain = suffixarray.repeated_spans
    monkeypatch.setattr(suffixarray, "repeated_spans", lambda t, w: plain(t, w, gram=16, **limits))
    if limits:
        monkeypatch.setattr(anchors, "MOST_SENT", 0)
        monkeypatch.setattr(anchors, "MOST_COPIES", 0)
    got = suffixarray.remove(docs_of(spark, rows), width=120).collect()
    assert sorted(tuple(r)[:5] for r in got) == sorted(brute.substrings(rows, 120))
    assert all(brute.sha(bytes(r.kept)) == r.kept_sha256 for r in got)


def test_suffix_array_order():
    import numpy as np

    r = random.Random(1)
    for _ in range(40):
        s = "".join(r.choice("ab" if r.random() < 0.5 else "abcdefgh") for _ in range(r.randint(1, 120)))
        x = np.frombuffer(s.encode(), np.uint8).astype(np.int16)
        order, rank = suffixarray.suffix_array(x)
        assert order.tolist() == sorted(range(len(s)), key=lambda i: s[i:]) and all(order[rank[i]] == i for i in range(len(s)))
        lcp = suffixarray.common_prefixes(x, order)
        for a, b in zip(order, order[1:], strict=False):
            k = 0
            while max(a, b) + k < len(s) and s[a + k] == s[b + k]:
                k += 1
            assert lcp[b] == k


@pytest.mark.parametrize(("limits", "runs"), [({}, None), ({"shard_words": 600, "cross_words": 60}, None), ({"shard_words": 600, "cross_words": 60}, 1), ({}, 0)])
def test_suffix_trees(spark, rows, limits, runs, monkeypatch):
    if runs is not None:
        monkeypatch.setattr(anchors, "MOST_RUNS", runs)
    plain = suffixtree.repeated_spans
    monkeypatch.setattr(suffixtree, "repeated_spans", lambda t, w: plain(t, w, gram=5, **limits))
    got = suffixtree.remove(docs_of(spark, rows), width=20).collect()
    assert sorted(tuple(r)[:4] for r in got) == sorted(brute.passages(rows, 20))


def test_forest_with_small_groups(rows):
    bodies = [" ".join((t or "").split()).encode() for _, t in rows if t and len(t.split()) >= 20]
    a, b = suffixtree.Forest(bodies, 20), suffixtree.Forest(bodies, 20, group=50)
    same = lambda f: {frozenset(m) for m in _members(f)}
    assert same(a) == same(b)


def _members(forest):
    by = {}
    for i, n in enumerate(forest.node):
        if n >= 0:
            by.setdefault(int(n), []).append(i)
    return by.values()


def test_jaccard_templates(spark, monkeypatch):
    """Many texts of one template, in one group of equal prefix or under the same shingles, of which only some are similar: tiles meet in pairs."""
    monkeypatch.setattr(jaccard, "SPLIT", 4)
    monkeypatch.setattr(jaccard, "DENSE", 2)
    monkeypatch.setattr(jaccard, "MOST_POSTS", 20)
    r = random.Random(21)
    head = [f"h{i}" for i in range(24)]
    rows = []
    for i in range(60):
        tail = [f"t{r.randrange(4)}_{k}" for k in range(10)] if i % 2 else [f"u{r.randrange(3)}_{k // 5}" for k in range(10)]
        rows.append((i, " ".join(head + tail)))
    got = jaccard.join(docs_of(spark, rows)).collect()
    assert sorted(map(tuple, got)) == sorted(brute.similar(rows))


@pytest.mark.parametrize("members", [256, 2])
def test_jaccard(spark, rows, members, monkeypatch):
    monkeypatch.setattr(jaccard, "MEMBERS", members)
    if members == 2:
        monkeypatch.setattr(jaccard, "DENSE", 2)
        monkeypatch.setattr(jaccard, "SPLIT", 3)
        monkeypatch.setattr(jaccard, "MOST_POSTS", 0)
        monkeypatch.setattr(jaccard, "MOST_PAIRS", 0)
        monkeypatch.setattr(jaccard, "MOST", 0)
    got = jaccard.join(docs_of(spark, rows)).collect()
    assert sorted(map(tuple, got)) == sorted(brute.similar(rows))


def test_jaccard_chain_and_clique(spark):
    """Near copies that are linked through each other but not with the least one, and a large group of near copies."""
    base = [f"t{i}" for i in range(200)]
    chain = [(i, " ".join(["n%d_%d" % (i, k) if k < 8 * i else w for k, w in enumerate(base)])) for i in range(8)]
    clique = [(100 + i, " ".join(["c%d" % k if k != i % 190 else "e%d" % i for k in range(200)])) for i in range(150)]
    rows = chain + clique
    got = jaccard.join(docs_of(spark, rows)).collect()
    assert sorted(map(tuple, got)) == sorted(brute.similar(rows))


def test_jaccard_parts_of_a_group(spark):
    """a and c have equal prefixes in a quarter of the versions and are linked through b only: c is not in the component of its group's leader a."""
    r = random.Random(7)
    rows = []
    for k in range(120):
        w = ["w%d_%d" % (k, r.randrange(10**9)) for _ in range(16)]
        rows += [(3 * k, " ".join(w[:14])), (3 * k + 1, " ".join(w)), (3 * k + 2, " ".join(w[2:]))]
    got = jaccard.join(docs_of(spark, rows)).collect()
    assert sorted(map(tuple, got)) == sorted(brute.similar(rows))


def test_jaccard_bound_of_a_part(spark, monkeypatch):
    """The second is linked with the first, often in its group, and with the third, which the first's counts rule out."""
    monkeypatch.setattr(jaccard, "DENSE", 2)
    r = random.Random(8)
    rows = []
    for k in range(120):
        w = ["w%d_%d" % (k, r.randrange(10**9)) for _ in range(14)]
        other = [*w[:13], f"x{k}"]
        # a fourth, so that no shingle is rarer than the others
        rows += [(4 * k, " ".join(w)), (4 * k + 1, " ".join(other)), (4 * k + 2, " ".join(other[1:])), (4 * k + 3, " ".join(w[9:]))]
    got = jaccard.join(docs_of(spark, rows)).collect()
    assert sorted(map(tuple, got)) == sorted(brute.similar(rows))


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_components(spark, most):
    r = random.Random(3)
    links = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1100)]
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {c.node: c.component for c in components(spark.createDataFrame(links, "a long, b long"), most).collect()}
    assert got == {n: find(n) for a, b in links for n in (a, b) if a != b}


def test_sentencepiece(spark, rows):
    sentencepiece = pytest.importorskip("sentencepiece")
    sp = sentencepiece.SentencePieceProcessor(model_file=default_model())
    r = random.Random(2)
    parts = ["a", "th", "the ", " ", "  ", "\n", "\t", "▁", "é", "中", "😀", "<s>", "<0x0A>", "\x00", "ing", "23", ".", "é"]
    extra = [(1000 + i, "".join(r.choice(parts) for _ in range(r.randint(0, 15)))) for i in range(800)]
    every = rows + extra
    got = {r.doc_id: r for r in pieces.encode(docs_of(spark, every), default_model(), carry=("lang", "t")).collect()}
    for d, t in every:
        ids = sp.encode(t or "")
        assert got[d].ids == ids and got[d].decoded == sp.decode(ids) and got[d].n_tokens == len(ids) and got[d].t == "z"
        assert got[d].ids_sha256 == brute.sha(",".join(map(str, ids))) and got[d].decoded_sha256 == brute.sha(sp.decode(ids))


def test_decode_any_ids():
    sentencepiece = pytest.importorskip("sentencepiece")
    sp = sentencepiece.SentencePieceProcessor(model_file=default_model())
    model, r = pieces.pieces(default_model()), random.Random(4)
    for _ in range(2000):
        ids = [r.choice([0, 1, 2, *range(3, 259), *range(259, 32000, 7)]) for _ in range(r.randint(0, 8))]
        assert model.decode(ids) == sp.decode(ids)


@pytest.mark.parametrize(("held", "files"), [(1 << 30, True), (100, True), (5000, False)])
def test_top_k(spark, held, files, monkeypatch):
    monkeypatch.setattr(topk, "HELD_BYTES", held)
    assert topk.readable(["file:///tmp/x"]) and not topk.readable(["nosuch://host/x"])
    if not files:
        monkeypatch.setattr(topk, "readable", lambda names: False)
    r = random.Random(6)
    vectors = [(i, [r.gauss(i % 3, 1) for _ in range(8)]) for i in range(400)] + [(400 + i, [float(i % 2)] * 8) for i in range(60)]
    vectors += [(1000, None), (1020, []), (1040, [float("nan")] * 8), (1060, [None] * 8), (1080, [1.0] * 3), (1001, [2.0] * 3), (1100, [1e7] * 8), (None, [1.0] * 8)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(5)
    got = {tuple(x) for x in topk.top_k(df, df.where("vec_id % 20 = 0"), k=20).collect()}
    assert got == brute.top_k(vectors, 20)
    got = {tuple(x) for x in topk.top_k(df, df.where("vec_id % 20 = 0"), k=20, block=3).collect()}
    assert got == brute.top_k(vectors, 20)


def test_toxicity(spark):
    r = random.Random(7)
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randint(3, 8))) for _ in range(400)]
    rows = [(i, " ".join(r.choice(words) for _ in range(40)) + (" zorgblat%s zorgblat" % r.choice("xyz") if i % 6 == 0 else "")) for i in range(1500)]
    labels = spark.createDataFrame([(i, int(i % 6 == 0)) for i, _ in rows if zlib.crc32(str(i).encode()) % 3 != 1], "doc_id long, toxic int")
    lexicon = toxicity.learn(docs_of(spark, rows), labels)
    got = {x.doc_id: x.score for x in toxicity.score(docs_of(spark, [*rows, (9000, None), (9001, ""), (9002, "Такой idiоt m0ron")]), lexicon).collect()}
    assert all((got[i] >= 0.7) == (i % 6 == 0) for i, _ in rows) and got[9000] == got[9001] < 0.5 and got[9002] >= 0.7
    assert toxicity.Lexicon({" clown ": 3.0}).weigh(toxicity.fold("The clown fish swims")) == 0
    assert {x.h for x in spark.createDataFrame([(i,) for i in range(50)], "doc_id long").select("doc_id", toxicity.held_out("doc_id").alias("o")).select(F.expr("cast(o as int) = cast(pmod(crc32(cast(doc_id as string)), 3) = 1 as int)").alias("h")).collect()} == {True}


def test_url_rules(spark):
    urls = ["https://a.example.com/en/1", "https://www.example.com/en/1", "https://m.www.example.com/en/", "http://x.net/es/", "http://x.net/fr/a?b=://c", "http://x.net/de/", "ftp://COM/", "https://com", "nothing", None, "", "http://notexample.com/en/", "http://h?q=/x", "http://X.Net/ES/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("clash"))
    good = spark.createDataFrame([(i, 1) for i in range(0, 14, 2)], "page_id long, good long")
    got = {r.page_id: r for r in urlfilter.judge(pages, good).collect()}
    assert [got[i].rule for i in range(14)] == ["example.com/en/", "www.example.com/en/", "www.example.com/en/", "net/es/", "net/fr/", None, "com/", None, None, None, None, "com/", None, None]
    assert [got[i].verdict for i in (0, 1, 3, 4, 6)] == ["block", "allow", "block", "block", "allow"]
    assert (got[9].host, got[9].path, got[4].host, got[4].path, got[12].host, got[12].path, got[13].host, got[13].path) == ("", "", "x.net", "/fr/a", "h", "", "x.net", "/ES/")
    assert all(r.verdict in ("allow", "block") for r in got.values())


def test_public_suffixes(spark, tmp_path):
    path = tmp_path / "suffixes"
    path.write_text("// a list\ncom\nco.uk\n\n*.ck\n!www.ck\nkawasaki.jp\n*.kawasaki.jp\nуа.орг more\n", encoding="utf-8")
    hosts = {"a.b.com": ("com", "b.com"), "x.y.co.uk": ("co.uk", "y.co.uk"), "a.b.z.ck": ("z.ck", "b.z.ck"), "a.www.ck": ("ck", "www.ck"), "ck": ("ck", "ck"), "a.b.c.kawasaki.jp": ("c.kawasaki.jp", "b.c.kawasaki.jp"), "other.tld": ("tld", "other.tld"), "com": ("com", "com"), "": ("", "")}
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    suffixes = urlfilter.public_suffixes(str(path))
    assert suffixes[-1].isascii() and "xn--" in suffixes[-1]
    assert {r.host: (r.suffix, r.domain) for r in urlfilter.levels(df, suffixes).collect()} == hosts


def test_url_reputation_shrinks(spark):
    pages = spark.createDataFrame([(i, f"http://bad.one.org/{i}") for i in range(60)] + [(100 + i, f"http://good{i}.two.org/") for i in range(60)] + [(500, "http://new.one.org/"), (501, "http://new.two.org/")], "page_id long, url string")
    outcomes = spark.createDataFrame([(i, 0) for i in range(60)] + [(100 + i, 1) for i in range(60)], "page_id long, good long")
    got = {r.page_id: r for r in urlfilter.judge(pages, outcomes).collect()}
    assert got[0].verdict == "block" and got[500].verdict == "block" and got[501].verdict == got[100].verdict == "allow"
    assert 0 < got[0].rate < got[501].rate < 1


def test_license(spark):
    s = license_scan.SENTENCES
    bsd = ". ".join(s[x] for x in ("bsd-redistribution", "bsd-source", "bsd-binary")) + "."
    rows = [(1, "x.\nReleased under the MIT License.\n"), (2, f"{bsd}\n{s['bsd-endorse']}."), (3, bsd), (4, None), (5, ""), (6, "licensed under cc  by-nc 4.0! Licensed under CC BY 4.0"), (7, "MIT License"), (8, s["apache-you"] + ";\n" + s["apache-not-use"] + ".\n" + s["apache-you"])]
    got = {r.doc_id: r.licenses for r in license_scan.scan(docs_of(spark, rows)).collect()}
    assert got == {1: "MIT", 2: "BSD-3-Clause", 3: "BSD-2-Clause", 4: "", 5: "", 6: "CC-BY-4.0,CC-BY-NC-4.0", 7: "", 8: "Apache-2.0"}


MIT = """Copyright (c) 2020 A. Person

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE."""
MPL = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU General Public License for more details."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""


def test_license_real_notices(spark):
    """Unwrapped, wrapped, and wrapped behind comment leaders; a known sentence must not go on in its line or paragraph's next sentence."""
    want = [(MIT, "MIT"), (MPL, "MPL-2.0"), (GPL, "GPL-3.0-or-later"), (BSD, "BSD-3-Clause"), (APACHE, "Apache-2.0")]
    rows, names = [], {}
    for text, name in want:
        for width in (0, 60, 76):
            for leader in ("", " * ", "# "):
                lines = [x for part in text.split("\n") for x in (textwrap.wrap(part, width) if width and part else [part])]
                rows.append((len(rows), "\n".join((leader + x).rstrip() for x in lines)))
                names[len(rows) - 1] = name
    for text in ("Licensed under the\n\nMIT License", "Licensed under the. MIT License", "Licensed under the MIT License or not"):
        rows.append((len(rows), text))
        names[len(rows) - 1] = ""
    assert {r.doc_id: r.licenses for r in license_scan.scan(docs_of(spark, rows)).collect()} == names


def test_license_long_runs(spark):
    """Runs of other characters don't count towards a sentence's length."""
    rows = [(1, "/" + "*" * 5000 + " Released under the MIT License " + "*" * 5000 + "/"), (2, "Licensed under" + " " * 5000 + "CC BY 4.0")]
    assert {r.doc_id: r.licenses for r in license_scan.scan(docs_of(spark, rows)).collect()} == {1: "MIT", 2: "CC-BY-4.0"}


CLASH = ["dropped", "__hash", "__doc", "__row", "score", "__score", "id", "doc", "t", "u", "rep", "starts", "ends", "items", "text_", "n", "bins", "tok", "bucket", "body", "k", "good", "rate", "suffix", "domain", "a", "b", "v", "q", "query_id", "rank", "label", "class", "term", "m", "key"]


def with_clashes(df, number=False):
    have = {c.lower() for c in df.columns}
    return df.select("*", *[(F.lit(7).cast("long") if number else F.lit("clash")).alias(c) for c in CLASH if c not in have])


def test_clashing_columns(spark, rows):
    """Extra columns, named like those inside the operators, change no result, in any of the tables; dedup() keeps them."""
    plain = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    wide = with_clashes(plain)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    same = lambda f: sorted(map(repr, map(tuple, f(plain, lambda x: x).collect()))) == sorted(map(repr, map(tuple, f(wide, with_clashes).collect())))
    assert same(lambda d, w: decontam.digest(decontam.matches(d, w(bench))))
    assert same(lambda d, w: suffixarray.remove(d, keep=False)) and same(lambda d, w: suffixtree.remove(d, keep=False))
    assert same(lambda d, w: linededup.digest(d)) and same(lambda d, w: jaccard.join(d)) and same(lambda d, w: license_scan.scan(d))
    assert same(lambda d, w: pieces.encode(d, default_model(), keep_ids=False, keep_text=False))
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    assert same(lambda d, w: toxicity.score(d, toxicity.learn(d, w(labels))))
    got = linededup.dedup(wide)
    assert got.columns == wide.columns and sorted(got.select("doc_id", "text").collect(), key=repr) == sorted(linededup.dedup(plain).collect(), key=repr)
    assert got.where("__hash <> 'clash' or dropped <> 'clash'").count() == 0
    pages = spark.createDataFrame([(i, f"http://h{i % 4}.org/{i}") for i in range(20)], "page_id long, url string")
    outcomes = spark.createDataFrame([(i, i % 2) for i in range(10)], "page_id long, good long")
    assert sorted(urlfilter.judge(with_clashes(pages), with_clashes(outcomes)).collect()) == sorted(urlfilter.judge(pages, outcomes).collect())
    vectors = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(50)], "vec_id long, embedding array<double>")
    more = with_clashes(vectors, True)
    assert sorted(topk.top_k(more, more.where("vec_id % 20 = 0")).collect()) == sorted(topk.top_k(vectors, vectors.where("vec_id % 20 = 0")).collect())


def test_repeated_rows_of_other_operators(spark):
    """Repeated rows: URL filter, licences, toxicity and search give each row its result, and a repeated query one."""
    pages = spark.createDataFrame([(1, "http://a.org/x")] * 3 + [(2, None)] * 2, "page_id long, url string")
    assert urlfilter.judge(pages, spark.createDataFrame([(1, 1)], "page_id long, good long")).count() == 5
    docs = docs_of(spark, [(1, "Released under the MIT License")] * 3 + [(2, None)] * 2 + [(None, "x")] * 2)
    got = [(r.doc_id, r.licenses) for r in license_scan.scan(docs).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, [(1, "MIT")] * 3 + [(2, "")] * 2 + [(None, "")] * 2))
    assert toxicity.score(docs, toxicity.Lexicon({})).count() == 7
    vectors = [(20, [1.0, 2.0]), (20, [1.0, 2.0]), (1, [3.0, 1.0]), (1, [3.0, 1.0]), (2, [0.0, 1.0]), (40, [1.0, 2.0])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in topk.top_k(df, df.where("vec_id % 20 = 0"), k=3).collect()]
    assert sorted(got) == sorted([(20, 1, 1, 20480), (20, 2, 1, 20480), (20, 3, 40, 20480), (40, 1, 1, 20480), (40, 2, 1, 20480), (40, 3, 20, 20480)])


def test_very_long_texts(spark):
    """A text of megabytes, with a word, a line and a sentence as long, passes whole through the operators on texts."""
    r = random.Random(31)
    body = " ".join("w%d" % r.randrange(10**6) for _ in range(300_000))
    rows = [(1, body), (2, "x" * 1_500_000 + " " + body[-3000:]), (3, body[:1_000_000] + "\nend of it"), (4, "short")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    item = " ".join(body.split()[299_980:299_995])
    got = {r.doc_id: (r.n_words, r.n_hit) for r in decontam.digest(decontam.matches(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))).collect()}
    assert got[1] == (300_000, 15) and got[2][1] == 15 and got[3][1] == 0
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in suffixarray.remove(docs, keep=False).collect()}
    assert got[1] == (len(body), 1_003_000, 2) and got[3] == (1_000_010, 1_000_000, 1) and got[2][:2] == (1_503_001, 1_503_000)
    got = {r.doc_id: (r.n_words, r.n_removed) for r in suffixtree.remove(docs, keep=False).collect()}
    n, last = len(body[:1_000_000].split()), len(body[-3000:].split())
    assert got[1] == (300_000, 0) and n - 1 <= got[3][1] <= n and last - 1 <= got[2][1] <= last
    assert {r.doc_id: (r.n_lines, r.n_dropped) for r in linededup.digest(docs).collect()} == {1: (1, 0), 2: (1, 0), 3: (2, 0), 4: (1, 0)}
    assert {r.doc_id: r.component_id for r in jaccard.join(docs).collect()} == {1: 1, 2: 2, 3: 3, 4: 4}
    assert {r.licenses for r in license_scan.scan(docs_of(spark, [(1, body + ". Released under the MIT License"), (2, "Released under " + " " * 2_000_000 + "the MIT License")])).collect()} == {"MIT"}
    assert toxicity.score(docs_of(spark, [(1, body + " idiot moron")]), toxicity.Lexicon({" idiot ": 6.0, " moron ": 6.0})).first().score > 0.5


def test_license_sql(spark):
    """The operator and its SQL agree on real notices in any layout, on runs of marks and on broken sentences."""
    duckdb = pytest.importorskip("duckdb")
    rows = []
    for text in (MIT, MPL, GPL, BSD, APACHE):
        for width in (0, 40, 61, 76):
            for leader in ("", " * ", "# "):
                lines = [x for part in text.split("\n") for x in (textwrap.wrap(part, width) if width and part else [part])]
                rows.append((len(rows), "\n".join((leader + x).rstrip() for x in lines)))
    r = random.Random(13)
    parts = [*license_scan.SENTENCES.values(), ". ", ".\n", "\n", "\r\n", "\n\n", " ", "!", "...", "\n * ", "x", "v. 2.0", "\t", "é", "S", "N", "/", "|"]
    rows += [(1000 + i, "".join(r.choice(parts) for _ in range(r.randint(1, 12)))) for i in range(600)] + [(5000, None), (5001, "")]
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    want = sorted(con.sql(f"select doc_id, n_known, sentence_ids, licenses from ({license_scan.oracle()})").fetchall())
    assert sorted(map(tuple, license_scan.scan(docs_of(spark, rows)).select("doc_id", "n_known", "sentence_ids", "licenses").collect())) == want
    assert sum(bool(w[3]) for w in want) > 100


def test_toxicity_learning(spark):
    """The learnt terms and weights against a plain version, with hot classes of near copies dealt over tasks."""
    r = random.Random(17)
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randint(3, 8))) for _ in range(300)]
    bad = ["zorgblat", "zorgblats", "quxify", "m0ronic"]
    rows = []
    for i in range(700):
        t = " ".join(r.choice(words) for _ in range(25))
        rows.append((i, t + (" %s %s!" % (r.choice(bad), r.choice(bad)) if i % 5 == 0 else "")))
    rows += [(1000 + i, rows[0][1] + f" copy{i % 3}") for i in range(40)] + [(2000, None), (2001, ""), (5, rows[5][1])]
    labels = [(i, int(i % 5 == 0 or i >= 1000)) for i, _ in rows[:-1]] + [(3, 1), (None, 1), (10, None)]
    want = brute.lexicon(rows, labels, toxicity)
    for most in (200, 5):
        toxicity.CLASS_ROWS, before = most, toxicity.CLASS_ROWS
        try:
            got = toxicity.learn(docs_of(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
        finally:
            toxicity.CLASS_ROWS = before
        assert got.terms.keys() == want.keys() and all(abs(got.terms[t] - w) < 1e-9 for t, w in want.items())
        assert any("zorg" in t for t in got.terms) and any("quxi" in t for t in got.terms)


def test_repeated_rows_and_nulls(spark):
    """Repeated rows, rows without an id, and null texts pass through every operator."""
    rows = [(1, "a b c d e f g h " * 30), (1, "a b c d e f g h " * 30), (2, "z y x w v u " * 40), (None, "z y x w v u " * 40), (None, None), (3, None), (3, "")]
    docs = docs_of(spark, rows)
    bench = spark.createDataFrame([(1, "a b c d e f g h a b c"), (1, None)], "item_id long, text string")
    assert decontam.digest(decontam.matches(docs, bench)).count() == linededup.digest(docs).count() == pieces.encode(docs, default_model()).count() == jaccard.join(docs).count() == len(rows)
    a = suffixarray.remove(docs, width=100, keep=False).collect()
    assert sorted((r.n_bytes, r.n_removed) for r in a) == [(0, 0), (0, 0), (0, 0), (480, 480), (480, 480), (480, 480), (480, 480)]
    t = {(r.doc_id, r.n_removed) for r in suffixtree.remove(docs, width=20, keep=False).collect()}
    assert (1, 0) in t and (2, 0) in t and (3, 0) in t
    j = {(r.doc_id, r.component_id) for r in jaccard.join(docs).collect()}
    assert {(1, 1), (2, 2), (3, 3)} <= j


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DDL)
    bench = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert decontam.digest(decontam.matches(docs, bench)).count() == 0
    assert linededup.digest(docs).count() == suffixarray.remove(docs).count() == suffixtree.remove(docs).count() == jaccard.join(docs).count() == 0
    assert license_scan.scan(docs).count() == pieces.encode(docs, default_model()).count() == 0
    assert toxicity.score(docs, toxicity.learn(docs, labels)).count() == 0
    assert urlfilter.judge(spark.createDataFrame([], "page_id long, url string"), spark.createDataFrame([], "page_id long, good long")).count() == 0
    empty = spark.createDataFrame([], T.StructType.fromDDL("vec_id long, embedding array<float>"))
    assert topk.top_k(empty, empty).count() == 0
