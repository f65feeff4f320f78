"""The pipeline's stages, each against a plain version on its own input, and run() as a whole."""

import os

import brute
import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=lambda x: x[0])


def test_stages(spark):
    sentencepiece = pytest.importorskip("sentencepiece")
    import corpus_pipeline as C
    from tessera.llm import toxicity
    from tessera.llm.common import table, written
    from tessera.llm.queries import default_model

    docs = table(spark, SF, "documents")
    got = [docs]
    for name, stage in C.STAGES:
        got.append(written(stage(spark, got[-1], SF), name))
    assert all(d.columns == docs.columns for d in got[:-1])
    rows = [pairs(d) for d in got[:-1]]

    lexicon = toxicity.learn(docs, table(spark, SF, "labels").where(~toxicity.held_out("doc_id")))
    assert rows[1] == [(d, t) for d, t in rows[0] if lexicon.score(t or "") < 0.7]
    assert {d for d, _ in rows[0]} - {d for d, _ in rows[1]}

    assert [(d, len((t or "").split("\n")), brute.sha(t or "")) for d, t in rows[2]] == [(d, n - k or 1, s) for d, n, k, s in brute.line_dedup(rows[1])]
    assert all(r.n_chars == len(r.text) for r in got[2].collect() if r.text is not None)

    component = {d: c for d, _, c in brute.similar(rows[2])}
    assert rows[3] == [(d, t) for d, t in rows[2] if component[d] == d]

    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    bad = {d for d, _, n, *_ in brute.decontamination(rows[3], items) if n}
    assert rows[4] == [(d, t) for d, t in rows[3] if d not in bad]

    sp = sentencepiece.SentencePieceProcessor(model_file=default_model())
    assert {r.doc_id: r.ids for r in got[5].collect()} == {d: sp.encode(t or "") for d, t in rows[4]}
    assert sorted(map(repr, C.run(spark, SF).collect())) == sorted(map(repr, got[5].collect()))


DOCS = "doc_id long, text string, lang string, source string, n_chars long, dropped string, __hash string, score double"


def folder(spark, path, rows, labels, items):
    """Tables as files, documents with extra columns whose names clash with those inside the operators."""
    spark.createDataFrame([(d, t, "en", "s", None if t is None else len(t), "x", "y", 1.0) for d, t in rows], DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages_on_awkward_rows(spark, tmp_path):
    """Nulls in any column, empty texts, repeated rows and ids, clashing names: each stage against a plain version on its own input."""
    import random

    import corpus_pipeline as C
    from tessera.llm.common import table, written

    r = random.Random(41)
    prose = lambda n: " ".join("w%d" % r.randrange(5000) for _ in range(n))
    line, item = "this very line is in many documents", prose(12)
    rows = [(i, prose(40) + f"\n{line}\n" + prose(5)) for i in range(1, 7)] + [(7, None), (8, ""), (9, "you idiot, you moron, you stupid scum"), (10, prose(30) + " " + item)]
    rows += [rows[0], rows[9], (7, None), (11, rows[1][1] + " more"), (None, prose(20)), (None, None), (None, "idiot moron scum"), (12, rows[3][1]), (12, prose(30)), (13, line)]
    sf = folder(spark, tmp_path, rows, [(9, None, 1), (None, 1, 0), (1, 0, None)], [(None, None), (1, item), (2, ""), (None, "only here")])
    got = [table(spark, sf, "documents")]
    for name, stage in C.STAGES:
        got.append(written(stage(spark, got[-1], sf), name))
    assert all(g.columns == C.COLUMNS for g in got[1:-1])
    plain = [sorted(((x.doc_id, x.text) for x in g.select("doc_id", "text").collect()), key=repr) for g in got[:-1]]
    assert plain[1] == sorted(((d, t) for d, t in rows if "idiot" not in (t or "")), key=repr)
    known = [(d, t) for d, t in plain[1] if d is not None]
    want = sorted((d, n - k, s) for d, n, k, s in brute.line_dedup(known))
    assert sorted((d, len(t.split("\n")) if t else 1, brute.sha(t or "")) for d, t in plain[2] if d is not None) == [(d, n or 1, s) for d, n, s in want]
    assert [x for x in plain[2] if x[0] is None] == [x for x in plain[1] if x[0] is None] and (7, None) in plain[2] and (8, "") in plain[2]
    assert {x.n_chars == len(x.text) for x in got[2].collect() if x.text is not None} == {True}
    kept = {d for d, _ in plain[3]}
    assert not {11, 12} & kept and {1, 7, 8, 10, 13} <= kept and [x for x in plain[3] if x[0] in kept] == [x for x in plain[2] if x[0] in kept]
    assert plain[4] == [x for x in plain[3] if x[0] != 10]
    assert got[5].count() == len(plain[4]) == C.run(spark, sf).count() and {x.n_tokens for x in got[5].where("doc_id in (7, 8)").collect()} == {0}


def test_empty_tables_pass(spark, tmp_path):
    import corpus_pipeline as C

    assert C.run(spark, folder(spark, tmp_path, [], [], [])).count() == 0
