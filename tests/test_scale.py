"""What keeps the queries whole on larger tables: no broadcast of notes, mentions and terms met once each."""

import numpy as np
from pyspark.sql import functions as F

from marginalia.operators import assertion, extraction, sections, terminology
from marginalia.sources import readers


def plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


LEXICON = "text string, type string, assertions array<string>, candidates array<string>, count int"


def test_memory_lexicon_broadcasts_the_lexicon_alone(spark, monkeypatch):
    lex = spark.createDataFrame([("phổi", "X", [], [], 9), ("Viêm phổi", "X", [], [], 3)], LEXICON)
    n = spark.range(40).select(F.col("id").cast("string").alias("record_id"), F.concat(F.lit("VIÊM PHỔI và phổi "), F.col("id").cast("string")).alias("raw_text"))
    rows = extraction.memory_lexicon(n, lex)
    text = plan(rows)
    assert text.count("BroadcastExchange") == 1 and "SortMergeJoin" in text
    small = sorted(map(str, rows.collect()))
    assert len(small) == 80
    monkeypatch.setattr(extraction, "_SMALL_LEXICON", 1)
    rows = extraction.memory_lexicon(n, lex)
    assert "BroadcastExchange" not in plan(rows)
    assert sorted(map(str, rows.collect())) == small


def test_lab_block_folds_its_text_once(spark):
    n = spark.createDataFrame([("Kết quả xét nghiệm:\n- WBC: 9", 22), ("Kết quả xét nghiệm:\nChẩn đoán: WBC", 31), ("WBC", 1), (None, 1)], "raw_text string, at int")
    rows = n.select(sections.in_lab_block(F.col("raw_text"), F.col("at")).alias("inside"))
    assert [r.inside for r in rows.collect()] == [True, False, False, False]
    assert rows._jdf.queryExecution().analyzed().toString().count("decompose") <= 4


def test_lexicon_join_puts_ngrams_together(spark):
    n = spark.createDataFrame([("a", "İ that  this, THE " + "x " * 700 + "of"), ("b", "that this"), ("c", ""), ("d", None)], "record_id string, raw_text string")
    rows = extraction.lexicon_join(n, spark.createDataFrame([("the",), ("that this",), ("this",), ("of",)], "alias string"))
    got = sorted((r.record_id, r.start, r.end, r.alias) for r in rows.collect())
    assert got == [("a", 8, 12, "this"), ("a", 14, 17, "the"), ("a", 1418, 1420, "of"), ("b", 0, 9, "that this")]


def test_closure_of_a_chain_and_a_cycle(spark):
    nodes = spark.range(14).selectExpr("'n' AS model", "cast(id AS string) AS id", "'n' AS parent_model", "cast((id + 13) % 14 AS string) AS parent_id", "concat('K', id) AS code", "'x' AS name")
    rows = readers.tree_closure(nodes, nodes.where("id = '3'").select("model", "id"))
    assert len(rows._jdf.queryExecution().logical().toString()) < 20_000
    assert {r.concept_id: r.level for r in rows.collect()} == {f"ICD10:K{i}": (i - 3) % 14 for i in range(14)}


def mentions_and_terms(spark):
    rows = spark.range(60).selectExpr("id AS ord", "concat('c', id % 50) AS concept_id", "concat(if(id % 2 = 0, 'red ', 'blue '), if(id % 3 = 0, 'bolt ', 'ring '), id % 4, ' mg') AS name", "'RxNorm' AS source", "'drug' AS semantic_type", "cast(array() AS array<string>) AS aliases", "'v' AS version", "'en' AS language", "'SCD' AS term_type")
    m = spark.range(6).selectExpr("cast(id AS string) AS mention_id", "if(id < 4, 'red bolt 2 mg', 'no blue') AS mention", "'drug' AS concept_type")
    return m, terminology.terms(rows)


def once(rows):
    return "Aggregate [mention" in rows._jdf.queryExecution().optimizedPlan().toString()


def test_token_lookup_of_equal_mentions(spark):
    m, t = mentions_and_terms(spark)
    rows = terminology.token_lookup(m, t, 12)
    assert once(rows)
    terms = t.select("term_ord", "concept_id", "norm").collect()
    for r in m.collect():
        line = sorted((i, x.term_ord, x.concept_id) for i, w in enumerate(r.mention.split()) for x in terms if len(w) >= 3 and w in x.norm.split())
        want = list(dict.fromkeys(c for _, _, c in line))[:12]
        assert [x.concept_id for x in rows.where(F.col("mention_id") == r.mention_id).orderBy("place").collect()] == want


def test_strength_lookups_of_equal_mentions(spark):
    m, t = mentions_and_terms(spark)
    rows = terminology.strength_lookup(m, t)
    assert once(rows)
    assert {r.mention_id: r["count"] for r in rows.groupBy("mention_id").count().collect()} == {str(i): 15 for i in range(4)}
    best = terminology.strength_candidates(m, t)
    assert once(best)
    want = {f"c{i % 50}" for i in range(60) if i % 6 == 0 and i % 4 == 2}
    assert all({r.concept_id for r in best.where(F.col("mention_id") == str(i)).collect()} == want for i in range(4))


def test_fuzzy_lookup_finds_every_name(spark):
    names = ["abcd", "x abcd", "zz abéx", "red bolt 5 mg", "bolt red 5 mg", "red bolt 50 mg", "q" * 70 + "rs", "qa", "blue ring"]
    asked = ["abxcd", "red bolt 5 mg", "mg 5 bolt red", "q" * 69 + "trs", "zzabéx", "abcd zz", None, ""]
    rows = spark.createDataFrame([(i, f"c{i}", x) for i, x in enumerate(names)], "ord long, concept_id string, name string")
    t = terminology.terms(rows.selectExpr("*", "'RxNorm' AS source", "'drug' AS semantic_type", "cast(array() AS array<string>) AS aliases", "'v' AS version", "'en' AS language", "'IN' AS term_type"))
    m = spark.createDataFrame([(str(i), x, "drug") for i, x in enumerate(asked)], "mention_id string, mention string, concept_type string")
    for cutoff, limit in ((88, 20), (60, 2)):
        got = [(r.mention_id, r.concept_id, r.ratio) for r in terminology.fuzzy_lookup(m, t, cutoff, limit).orderBy("mention_id", "place").collect()]
        want = []
        for i, a in enumerate(asked):
            fit = sorted((-terminology._set_ratio(a or "", b), j) for j, b in enumerate(names) if terminology._set_ratio(a or "", b) >= cutoff)
            want += [(str(i), f"c{j}", -r) for r, j in fit[:limit]]
        assert got == want
    # no word and no three characters in a row are common
    assert ("0", "c0") in {(a, b) for a, b, _ in want}


def test_walk_of_prefixes_is_exact():
    import random

    from marginalia.functions.nearness import nearest

    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.choice((1, 4, 9, 80))))
    for cutoff, limit in ((50, 3), (88, 100)):
        names, asked = sorted({word() for _ in range(60)}), sorted({word() for _ in range(30)})
        first = rng.sample(range(999), len(names))
        want = []
        for a in asked:
            fit = sorted((-terminology._set_ratio(a, b), f, b) for b, f in zip(names, first) if a != b and terminology._set_ratio(a, b) >= cutoff)
            want += [(a, b, f, -r) for r, f, b in fit[:limit]]
        assert sorted(nearest(asked, names, first, cutoff, limit)) == sorted(want)


def test_equal_examples_are_one_that_weighs_as_much(spark):
    rows = [("không ho sốt", ["isNegated"], 9), ("ho sốt nhiều", [], 4), ("không đau ngực", ["isNegated"], 1), ("đau ngực", [], 2)]
    one = spark.createDataFrame(rows, "text string, assertions array<string>, copies long")
    every = one.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copies", "_i")
    a, b = (assertion.train_classifiers(x, ["isNegated"], 64)["isNegated"] for x in (one, every))
    assert abs(a.stages[-1].coefficients.toArray() - b.stages[-1].coefficients.toArray()).max() < 1e-6
    df = sum(n for text, _, n in rows if "không" in text)
    assert any(abs(x - np.log(17 / (df + 1))) < 1e-12 for x in a.stages[6].getScalingVec().toArray())


def test_strength_candidates_read_equal_names_once(spark):
    names = ["red bolt 2 mg / 5 ml", "red bolt 2 mg / 5 ml", "red bolt 5 ml", "red ring 2 mg", "Red  Bolt 2 MG tablet", "blue bolt 2 mg"]
    rows = spark.createDataFrame([(i, f"c{i % 5}", x) for i, x in enumerate(names)], "ord long, concept_id string, name string")
    t = terminology.terms(rows.selectExpr("*", "'RxNorm' AS source", "'drug' AS semantic_type", "cast(array() AS array<string>) AS aliases", "'v' AS version", "'en' AS language", "'SCD' AS term_type"))
    m = spark.createDataFrame([("0", "red bolt 5 ml / 2 mg", "drug"), ("1", "red bolt 2 mg tablet", "drug")], "mention_id string, mention string, concept_type string")
    best = terminology.strength_candidates(m, t)
    assert "Aggregate [name" in best._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.mention_id, r.concept_id, r.cand_ord.o, r.cand_ord.t) for r in best.collect()}
    assert got == {("0", "c0", 0, 0), ("0", "c1", 0, 1), ("0", "c2", 0, 2), ("0", "c4", 1, 4), ("1", "c4", 0, 4)}


def test_cascade_normalizes_once_and_stops(spark, monkeypatch):
    rows = spark.createDataFrame([(0, "c0", "Đái Tháo", ["Tiểu Đường", None]), (1, "c1", "dai thao", None), (2, "c2", "Suy tim", []), (3, "c0", "đái  tháo", ["suy TIM"])], "ord long, concept_id string, name string, aliases array<string>")
    t = terminology.terms(rows.selectExpr("*", "'ICD10_VI' AS source", "'diagnosis' AS semantic_type", "'v' AS version", "'vi' AS language", "cast(null AS string) AS term_type"))
    m = spark.createDataFrame([("0", "dai thao", "diagnosis"), ("1", "ĐÁI THÁO", "diagnosis"), ("2", "tieu duong", "diagnosis"), ("3", "suy tim", "diagnosis"), ("4", None, "diagnosis")], "mention_id string, mention string, concept_type string")

    def late(*_):
        raise AssertionError("every mention has a sure candidate")

    monkeypatch.setattr(terminology, "fuzzy_lookup", late)
    monkeypatch.setattr(terminology, "token_lookup", late)
    got = {(r.mention_id, r.concept_id, r.match_type, float(r.score), r.cand_ord.t) for r in terminology.candidates(m, t).collect()}
    # c1 has no accents, so it is no folded key: "ĐÁI THÁO" doesn't reach it
    assert got == {("0", "c0", "folded_exact", 0.92, 0), ("0", "c1", "exact", 1.0, 1), ("1", "c0", "exact", 1.0, 0), ("2", "c0", "folded_exact", 0.92, 0), ("3", "c0", "alias", 0.95, 3), ("3", "c2", "exact", 1.0, 2)}
