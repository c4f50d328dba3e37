"""Registered queries on a small table, and the pipeline against a plain version."""

import math
import struct
from pathlib import Path

import corpus_pipeline
import duckdb
import plain
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sessionflow.llm import queries


def connection(sf_dir):
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def test_every_operator_has_a_query():
    assert [n.split("_")[0] for n in queries.queries()] == [f"op{i}" for i in range(1, 14)]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, sf_dir, name):
    result = queries.queries()[name](spark, sf_dir)
    columns = sorted(result.columns)
    listed = ", ".join(columns)
    want = sorted(connection(sf_dir).execute(f"select {listed} from ({queries.oracle_sql()[name]})").fetchall())
    assert sorted(map(tuple, result.select(*columns).collect())) == want


def test_suffix_and_near_duplicates_of_the_table(spark, sf_dir):
    texts = dict(connection(sf_dir).execute("select doc_id, text from documents").fetchall())
    cut = plain.cut_repeats(texts, 50)
    for r in queries.queries()["op1_suffix_dedup"](spark, sf_dir).collect():
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == cut[r["doc_id"]]
    near = plain.near_duplicates(texts, 4, 80)
    for r in queries.queries()["op5_minhash"](spark, sf_dir).collect():
        assert (r["n_shingles"], r["component_id"]) == near[r["doc_id"]]


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = docs.columns
    toxic = {i for i, t in connection(sf_dir).execute("select doc_id, toxic from labels").fetchall() if t}
    clean = corpus_pipeline.reject_toxic(spark, docs, sf_dir)
    kept = {r["doc_id"]: r for r in clean.collect()}
    assert clean.columns == names
    assert len(toxic & set(kept)) <= len(toxic) // 2  # a dozen labels to learn from
    near = plain.near_duplicates({i: r["text"] for i, r in kept.items()}, 5, 80)
    alone = corpus_pipeline.drop_near_duplicates(spark, clean, sf_dir)
    assert alone.columns == names
    texts = {r["doc_id"]: r["text"] for r in alone.collect()}
    assert set(texts) == {i for i in kept if near[i][1] == i}
    cut = corpus_pipeline.cut_repeats(spark, alone, sf_dir)
    assert cut.columns == names
    removed = plain.cut_repeats(texts, 50)
    left = {r["doc_id"]: r for r in cut.collect()}
    for i, text in texts.items():
        if not removed[i][1]:
            assert left[i]["text"] == text
        elif i in left:  # some bytes of characters stay that the plain version cuts
            assert removed[i][0] - removed[i][1] <= len(left[i]["text"].encode()) <= removed[i][0] - removed[i][1] + 6 * removed[i][2]
            assert left[i]["n_chars"] == len(left[i]["text"])
    mixed = corpus_pipeline.mix_sources(spark, cut, sf_dir)
    assert mixed.columns == names
    words = lambda rows: sum(len(plain.lower_words(r["text"])) for r in rows)
    chosen = mixed.collect()
    assert math.isclose(words(chosen), 1.5 * words(left.values()), rel_tol=0.25)
    tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    want = sorted((r["doc_id"], tuple(tokenizer.encode(r["text"], add_special_tokens=False).ids)) for r in chosen)
    encoded = corpus_pipeline.encode(spark, mixed, sf_dir).collect()
    assert sorted((r["doc_id"], struct.unpack(f"<{r['n_tokens']}I", r["token_ids"])) for r in encoded) == want


def test_run_gives_the_last_stage(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).columns == ["doc_id", "lang", "source", "n_tokens", "token_ids"]


def test_run_gives_the_rows_of_its_stages(spark, sf_dir):
    """All rows of run(): near duplicates and encoding by plain versions, the other stages by their operators without
    the Parquet round trip. Documents labelled clean stay."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {r["doc_id"]: r for r in corpus_pipeline.reject_toxic(spark, docs, sf_dir).collect()}
    clean = {i for i, t in connection(sf_dir).execute("select doc_id, toxic from labels").fetchall() if not t}
    assert len(clean & set(kept)) >= 0.9 * len(clean)
    near = plain.near_duplicates({i: r["text"] for i, r in kept.items()}, 5, 80)
    texts = {i: r["text"] for i, r in kept.items() if near[i][1] == i}
    schema = docs.schema
    alone = spark.createDataFrame([kept[i] for i in texts], schema)
    cut = corpus_pipeline.cut_repeats(spark, alone, sf_dir)
    rows = {r["doc_id"]: r for r in corpus_pipeline.mix_sources(spark, cut, sf_dir).collect()}
    copies = {}
    for r in corpus_pipeline.mix_sources(spark, cut, sf_dir).collect():
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + 1
    tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    want = sorted((i, r["source"], tuple(tokenizer.encode(r["text"], add_special_tokens=False).ids)) for i, r in rows.items() for _ in range(copies[i]))
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted((r["doc_id"], r["source"], struct.unpack(f"<{r['n_tokens']}I", r["token_ids"])) for r in got) == want


def test_stages_bear_odd_rows(spark, tmp_path):
    """Nulls, blanks, copies and repeated rows pass all stages; a null text stays null where nothing is cut."""
    passage = "a passage of more than fifty bytes that stands in two of the documents here"
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, f"{passage} one", "en", "a", 5), (4, f"other words before {passage}", "en", None, 5), (5, passage, None, "b", 5), (5, passage, None, "b", 5), (None, "no id", "en", "a", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(3, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    cut = {(r["doc_id"], r["text"]) for r in corpus_pipeline.cut_repeats(spark, docs, str(tmp_path)).collect()}
    assert cut == {(1, None), (2, ""), (3, f"{passage} one"), (4, "other words before"), (None, "no id")} or (4, "other words before ") in cut
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            frame = stage(spark, frame, str(tmp_path))
            assert frame.columns == docs.columns
            frame.collect()
        corpus_pipeline.encode(spark, frame, str(tmp_path)).collect()


def test_further_columns_pass_whatever_their_names(spark, tmp_path):
    """Names that operators use for columns of their own, and one that the stages use for others."""
    names = ["suffix_null", "tox_severity", "suffix_kept", "mix_size", "kept", "further_1", "component_id"]
    rows = [(i, f"some words of document {i} " * (i + 1), "en", "a", 5, *[f"{n} {i}" for n in names]) for i in range(6)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names)
    docs = spark.createDataFrame(rows, schema)
    spark.createDataFrame([(3, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        found = out.collect()
        assert found and all(r[n] == f"{n} {r['doc_id']}" for r in found for n in names)
