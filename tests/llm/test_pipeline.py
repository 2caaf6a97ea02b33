"""The pipeline against plain versions of its stages, and the registered queries against SQL."""

import random

import duckdb
import numpy as np
import pytest

import __spark_entry__ as E
import corpus_pipeline
from brute import cut_repeats, jaccard_report, least_edits
from conftest import SF_SMALL
from tarmac.llm import decontaminate, piece_viterbi
from test_operators import edited, line_corpus, prose

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    rng = random.Random(21)
    docs, labels = line_corpus(rng, 150)
    items = [(i, prose(rng, 40)) for i in range(4)]
    texts = [t for _, t in docs]
    good = next(t for (_, t), (_, q, _) in zip(docs, labels) if q and len(t) > 200)

    def lines(k):
        return "\n".join(prose(rng, 12).capitalize() + "." for _ in range(k))

    def in_lines(text):
        words = text.split(" ")
        return "\n".join(" ".join(words[k: k + 12]).capitalize() + "." for k in range(0, len(words), 12))

    passage = lines(14)
    texts += [good, edited(rng, good, 0.01), None, "", "one"]
    texts += [lines(6) + "\n" + passage + "\n" + lines(8) for _ in range(3)]
    texts += [lines(3) + "\n" + in_lines(items[k][1]) + "\n" + lines(3) for k in range(2)]
    rows = [(i, t, "en", "src0", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, dict(items)


def test_stages_equal_plain_versions(spark, tables):
    from tarmac.llm.common import stored
    d, items = tables
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeats", "decontaminate", "tokens"]
    docs = spark.read.parquet(f"{d}/documents.parquet")
    steps = [{r.doc_id: r.text for r in docs.collect()}]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, d), "test-" + name)
        if name != "tokens":
            assert docs.columns == COLUMNS
            steps.append({r.doc_id: r.text for r in docs.collect()})
    start, quality, distinct, cut, clean = steps
    assert set(quality) < set(start) and all(quality[i] == start[i] for i in quality)
    assert set(distinct) == {i for i, (_, c) in jaccard_report(quality).items() if i == c}
    assert len(distinct) < len(quality)
    plain = cut_repeats(distinct, corpus_pipeline.PASSAGE_BYTES)
    assert cut == {i: None if distinct[i] is None else plain[i][4].decode("utf-8", "ignore") for i in distinct}
    assert any(cut[i] != distinct[i] for i in cut)

    def leaks(text):
        codes = decontaminate.code_points(text).tolist()
        for item in items.values():
            c = decontaminate.code_points(item).tolist()
            n = min(decontaminate.PASSAGE, len(c))
            if any(least_edits(c[f: f + n], codes) <= decontaminate.budget(n) for f in range(0, len(c) - n + 1, 3)):
                return True
        return False

    assert set(cut) - set(clean) == {i for i in sorted(cut)[-12:] if leaks(cut[i])} != set()
    assert all(clean[i] == cut[i] for i in clean)
    tokens = {r.doc_id: r for r in docs.collect()}
    assert set(tokens) == set(clean) and all(r.round_trip for r in tokens.values())
    lexicon = piece_viterbi.Lexicon()
    import pyarrow as pa
    for i, t in list(clean.items())[:20]:
        assert tokens[i].ids == piece_viterbi.encode_array(lexicon, pa.array([t], pa.string())).to_pylist()[0]


def test_run_is_the_chain_of_stages(spark, tables):
    d, _ = tables
    got = corpus_pipeline.run(spark, d)
    assert got.columns == ["doc_id", "ids", "n_tokens", "round_trip"]
    assert got.count() > 50 and got.where("not round_trip").count() == 0


def test_each_operator_has_one_query():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in E.queries()


def _plain(v):
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(_plain(x) for x in v)
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", ["op1_warc_captures", "op3_ego_join", "op4_ngram_jaccard", "op6_license_scan",
                                  "op10_chat_format", "op11_vector_codes", "op12_importance_draw"])
def test_queries_equal_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = E.queries()[name](spark, SF_SMALL)
    cur = con.execute(E.oracle_sql()[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns)
    want = sorted((tuple(_plain(r[cols.index(c)]) for c in df.columns) for r in cur.fetchall()), key=repr)
    assert sorted((tuple(_plain(v) for v in r) for r in df.collect()), key=repr) == want
