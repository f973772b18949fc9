"""The pipeline's stages on a small corpus with planted cases, and the registered queries."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pytest

import corpus_pipeline
from granary import session
from granary.llm.queries import ORACLE, QUERIES
from tests.compare import connect, differences
from tests.llm.test_simhash import brute_print, brute_roots

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's input and output rows, run one after another as the pipeline does."""
    folder, rows = tmp_path_factory.mktemp("pipeline"), {}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before = docs.collect()
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(folder / str(number))
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
        after = docs.collect()
        rows[name] = (before, after)
        before = after
    return rows


def test_stages_are_the_dealt_ones():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "simhash near-dedup", "benchmark decontamination", "source mixing", "sharding",
    ]


def test_columns_of_documents_stay(stages):
    for name, (before, after) in list(stages.items())[:-1]:
        assert after[0].__fields__ == before[0].__fields__, name
        assert set(after) <= set(before), name
    last = stages["sharding"][1][0].__fields__
    assert last[-2:] == ["shard", "slot"]


def test_run_gives_the_stages_rows_and_drops_what_no_stage_reads(spark, stages):
    with session.scratch_scope() as made:
        rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted(map(str, rows)) == sorted(map(str, stages["sharding"][1]))
    names = [name.replace(" ", "-") for name, _ in corpus_pipeline.STAGES[:-1]]
    written = {name: path for path in made for name in names if f"/{name}-" in path}
    assert [name for name in names if session.exists(spark, written[name])] == names[-1:]


def test_classifier_keeps_good_documents(spark, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    before, after = stages["quality classifier"]
    kept = {r.doc_id for r in after}
    good = [r.doc_id in kept for r in before if labels.get(r.doc_id) == 1]
    bad = [r.doc_id in kept for r in before if labels.get(r.doc_id) == 0]
    assert sum(good) > 0.97 * len(good) and sum(bad) < 0.3 * len(bad)


def test_near_dedup_against_brute_force(stages):
    before, after = stages["simhash near-dedup"]
    rows = sorted(before, key=lambda r: r.doc_id)
    roots = brute_roots([brute_print(r.text) for r in rows], 4)
    assert {r.doc_id for r in after} == {rows[i].doc_id for i in set(roots)}


def test_leaks_against_brute_force(spark, stages):
    def plain(text):
        return f" {' '.join(re.findall(r'\w+', text.lower()))} "

    items = [plain(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    before, after = stages["benchmark decontamination"]
    leaking = {r.doc_id for r in before if any(item in plain(r.text) for item in items)}
    assert leaking and {r.doc_id for r in after} == {r.doc_id for r in before} - leaking


def test_mix_meets_its_targets(stages):
    from granary.llm.mixing import targets

    before, after = stages["source mixing"]
    size = lambda text: len(re.findall(r"[^\x20\x09-\x0D]+", text))
    sizes, taken = Counter(), Counter()
    for r in before:
        sizes[r.source] += size(r.text)
    for r in after:
        taken[r.source] += size(r.text)
    names = sorted(sizes)
    aims = targets([sizes[n] for n in names], [(3, 1, 2)[i % 3] for i in range(len(names))])
    assert all(abs(taken[n] - float(aim)) < 0.06 * aim for n, aim in zip(names, aims))
    assert max(Counter(r.doc_id for r in after).values()) <= 2


def test_shards_hold_equal_texts_together(stages):
    before, after = stages["sharding"]
    assert Counter(r.doc_id for r in before) == Counter(r.doc_id for r in after)
    homes = {}
    for r in after:
        assert homes.setdefault(r.text, r["shard"]) == r["shard"]
    for shard in set(homes.values()):
        slots = sorted(r.slot for r in after if r["shard"] == shard)
        assert slots == list(range(len(slots)))


@pytest.mark.parametrize("frame", ["odd_documents", "no_documents"])
def test_every_stage_takes_odd_rows(spark, request, tmp_path, frame):
    docs = request.getfixturevalue(frame)
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(spark, docs, FOLDER)
        path = str(tmp_path / f"{frame}-{number}")
        result.write.parquet(path)
        written = spark.read.parquet(path)
        if number < 4:
            assert written.columns == docs.columns, name
            docs = written
        assert written.where("_unit <> 7 or _row <> 'r' or score <> 0.5 or n_words <> 'w'").count() == 0, name
    assert "shard" in written.columns and "slot" in written.columns


CONTRACT = {
    "op1_decontamination": {"doc_id": "bigint", "item_id": "bigint"},
    "op2_source_mixing": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op3_token_counts": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    "op4_chat_format": {"conv_id": "bigint", "n_turns": "bigint", "turns_sha256": "string", "loss_chars": "bigint", "loss_sha256": "string", "formatted_chars": "bigint"},
    "op5_sharding": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op6_secret_scan": {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"},
    "op7_simhash_dedup": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op8_html_extract": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op9_quality_rules": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op10_quality_classifier": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op11_lexical_search": {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"},
    "op12_prefix_trie": {"conv_id": "bigint", "depth": "bigint", "parent_conv_id": "bigint", "n_convs": "bigint", "n_children": "bigint", "n_leaves": "bigint", "saved_tokens": "bigint", "ends_sha256": "string"},
    "op13_exact_dedup": {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"},
}


def test_contracts_cover_the_queries():
    assert set(CONTRACT) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_query_has_its_contract(spark, name):
    frame = QUERIES[name](spark, FOLDER)
    types = dict(frame.dtypes)
    assert {column: types.get(column) for column in CONTRACT[name]} == CONTRACT[name]
    table = "pages" if name.startswith("op8") else "documents"
    if name.startswith("op4"):
        assert frame.select("conv_id").distinct().count() == frame.count()
    elif name.startswith("op12"):
        assert frame.select("conv_id", "depth").distinct().count() == frame.count()
    elif name.startswith("op11"):
        assert frame.select("item_id", "rank").distinct().count() == frame.count()
    elif not name.startswith("op1_"):
        assert frame.count() == spark.read.parquet(f"{FOLDER}/{table}.parquet").count()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_against_sql(spark, name):
    connection = connect(FOLDER)
    assert differences(QUERIES[name](spark, FOLDER), connection, ORACLE[name]) == []
    connection.close()


def test_secrets_query_against_brute_force(spark):
    from hashlib import sha256

    from tests.llm.test_secret_scan import brute

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    for row in QUERIES["op6_secret_scan"](spark, FOLDER).collect():
        spans = brute(texts[row.doc_id])
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        assert row.base_sha256 == sha256(joined.encode()).hexdigest()
        assert [row.n_assign, row.n_access, row.n_hex] == [sum(s[0] == k for s in spans) for k in ("assign", "access", "hex")]


def test_sharding_query_sizes(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    for row in QUERIES["op5_sharding"](spark, FOLDER).collect():
        raw = texts[row.doc_id].encode()
        assert (row["size"], row.text_crc32, row.law) == (len(raw) + 1, zlib.crc32(raw), "bytes")
