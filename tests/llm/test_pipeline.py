"""The whole pipeline against plain code for each stage."""

import random

import public_tokenizers
import pytest
from test_decontaminate import best_place
from test_exact_dedup import normal
from test_language import corpus
from test_simhash import brute as components
from tokenizers import Tokenizer

import corpus_pipeline
from trapiche.llm import queries
from trapiche.llm.decontaminate import error_budget, flag_leaks, plain

ITEMS = [(0, "the licence of the bard and the tomb of the singer of songs"), (1, "short item"), (2, None)]


def raw_documents():
    rows = [(own, text, lang) for own, text, lang in corpus(120, seed=4)]
    draw = random.Random(9)
    rows += [(200 + i, rows[i][1].replace(" ", "\n"), None) for i in range(0, 60, 3)]
    for i in range(1, 60, 6):
        words = rows[i][1].split() * 6
        rows.append((300 + i, " ".join(words), rows[i][2]))
        words[draw.randrange(len(words))] = "bartom"
        rows.append((400 + i, " ".join(words), rows[i][2]))
    rows += [(500, f"{rows[5][1]} {ITEMS[0][1].upper()}! {rows[6][1]}", "aa")]
    rows += [(501, f"{rows[8][1]} Short  item. {rows[9][1]}", "aa"), (502, "short items", "aa")]
    rows += [(600, None, "aa"), (601, "", None), (602, "12 34", "bb"), (602, "12 34", "bb")]
    rows += [(0, rows[0][1], rows[0][2])]
    return rows


@pytest.fixture(scope="module")
def folder(spark, documents, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    documents(raw_documents()).write.parquet(f"{path}/documents.parquet")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    items.write.parquet(f"{path}/benchmark.parquet")
    return path


def expected_documents():
    rows = {own: text for own, text, _ in raw_documents()}
    kept = {own: t for own, t in rows.items() if t and any(c.isalpha() for c in t)}
    first = {}
    for own in sorted(kept):
        first.setdefault(normal(kept[own]), own)
    kept = {own: kept[own] for own in first.values()}
    kept = {own: kept[own] for own, _, component in components(kept.items()) if own == component}

    def leaks(text):
        items = [plain(item) for _, item in ITEMS if plain(item)]
        return any(best_place(i, plain(text))[0] <= error_budget(len(i)) for i in items)

    return {own: text for own, text in kept.items() if not leaks(text)}


def test_run_equals_plain_stages(spark, folder):
    found = corpus_pipeline.run(spark, folder).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = {
        own: len(tokenizer.encode(text, add_special_tokens=False).ids) + 1
        for own, text in expected_documents().items()
    }
    lengths = {}
    for r in found:
        lengths[r["doc_id"]] = lengths.get(r["doc_id"], 0) + r["length"]
    assert lengths == expected
    assert 500 not in lengths and 501 not in lengths and 600 not in lengths


def test_stages_keep_the_columns_and_survive_an_empty_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    assert len(corpus_pipeline.STAGES) == 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        result = stage(spark, docs, folder)
        assert result.schema.fieldNames() == docs.schema.fieldNames()
        assert result.collect() == []
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect() == []


def test_stages_with_clashing_columns_and_nulls_everywhere(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    clash = docs.limit(3).selectExpr(
        "*", "'own' AS kept", "'own' AS score", "'own' AS keep_id", "'own' AS copy", "1 AS held_out"
    )
    nulls = clash.selectExpr(*[f"cast(null AS {t}) AS {c}" for c, t in clash.dtypes])
    both = clash.union(nulls)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, both, folder).columns == both.columns, name


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


def test_leaks_are_judged_row_by_row(spark, folder, documents):
    leak = f"before {ITEMS[0][1]} after"
    rows = [(None, leak), (None, "clean one"), (None, None), (7, "clean two"), (7, leak), (8, "")]
    decontaminate = dict(corpus_pipeline.STAGES)["benchmark_decontamination"]
    kept = decontaminate(spark, documents(rows), folder).collect()
    expected = [(own, text) for own, text in rows if text != leak]
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=str) == sorted(expected, key=str)


def test_flags_in_several_passes(spark, documents):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = documents([(1, f"x {ITEMS[0][1]}"), (1, "a short item"), (None, "none")])
    flagged = flag_leaks(docs, items, "leaks", block_chars=20).collect()
    assert sorted((r["text"], r["leaks"]) for r in flagged) == [
        ("a short item", True), ("none", False), (f"x {ITEMS[0][1]}", True)
    ]
