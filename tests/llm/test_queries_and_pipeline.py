"""The registered queries over whole tables, and the pipeline against plain code."""

import duckdb
import plain
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from wordmill.llm import quality, queries, secrets

COLUMNS = {
    "op1_html": "page_id url text n_chars",
    "op2_jaccard": "doc_id n_shingles component_id",
    "op3_idcoder": "doc_id start n_tokens ids_crc32",
    "op4_quality": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept anomaly",
    "op5_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op6_chaining": "doc_id start_word end_word ref_id ref_start ref_end n_seeds n_equal identity",
    "op7_secrets": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op8_lattice": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op9_suffix": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op10_decontam": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op11_middle": "doc_id n form prefix_chars middle_chars output_sha256 restored_sha256",
    "op12_counts": "doc_id n_bytes n_tokens over_limit",
    "op13_collocations": "lang rank phrase a l r n score",
}


def test_all_are_registered():
    assert set(queries.QUERIES) == set(COLUMNS)


@pytest.mark.parametrize("name", COLUMNS)
def test_rows(spark, folder, name):
    found = queries.QUERIES[name](spark, folder)
    assert found.columns == COLUMNS[name].split()
    if name not in ("op6_chaining", "op13_collocations"):
        source = "pages" if name == "op1_html" else "documents"
        assert found.count() == spark.read.parquet(f"{folder}/{source}.parquet").count()
    else:
        assert found.count() > 0


@pytest.mark.parametrize("name", queries.ORACLE)
def test_sql(spark, folder, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    found = queries.QUERIES[name](spark, folder)
    rows = duck.execute(queries.ORACLE[name]).fetchall()
    assert sorted(map(tuple, found.collect())) == sorted(rows)


def test_removal_against_plain_code(spark, folder):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    found = queries.op9_suffix(spark, folder)
    assert sorted(map(tuple, found.collect())) == plain.removed(docs)


def test_pipeline(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {r.doc_id for r in quality.judge(docs, quality.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))).collect() if r.kept}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in kept]
    stay = {k for k, _, root in plain.components(rows) if k == root}
    rows = [r for r in rows if r[0] in stay]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    dirty = {r[0] for r in plain.contamination(rows, items) if r[-1]}
    rows = [r for r in rows if r[0] not in dirty]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r.doc_id: r.secret_spans for r in secrets.scan(frame, secrets.fit(frame)).collect()}
    library = Tokenizer.from_file(queries.BYTE_BPE)
    expected = {}
    for key, text in rows:
        for s in sorted(spans[key], key=lambda s: -s.start):
            later = [o for o in spans[key] if o.start < s.start < o.end]
            if not later:
                end = max(o.end for o in spans[key] if s.start <= o.start < s.end or o is s)
                text = text[: s.start] + "[secret]" + text[end:]
        expected[key] = library.encode(text, add_special_tokens=False).ids
    found = {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, folder).collect()}
    assert found == expected


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert len(corpus_pipeline.STAGES) == 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).schema.simpleString() == docs.schema.simpleString()
