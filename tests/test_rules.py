"""Rules that depend on the very characters of a text: decomposed letters, line ends, changed lengths; and the way of
remembered notes."""

import unicodedata

from pyspark.sql import functions as F

from marginalia.functions import text as T
from marginalia.operators import algebra, assertion, extraction, sections, terminology
from marginalia.plans.inference import Plan, infer
from marginalia.sources import readers


def apart(text):
    return unicodedata.normalize("NFD", text)


def note(spark, *texts):
    return spark.createDataFrame([(f"r{i}", t) for i, t in enumerate(texts)], "record_id string, raw_text string")


def test_forms_agree_with_their_definition(spark):
    texts = ["ﬁne ½ Ａ①", apart("Đái tháo đường"), "Łódź ǆ ế", "á̧ x", "İ viêm", "plain", "", None, "한글 ガ"]
    def norm(t):
        t = unicodedata.normalize("NFKC", t).lower()
        return " ".join("".join(" " if c in "“”\"'`,:;()[]{}" else c for c in t).split())

    def fold(t):
        t = "".join(c for c in unicodedata.normalize("NFKD", norm(t).replace("đ", "d")) if not unicodedata.combining(c))
        return " ".join(unicodedata.normalize("NFKC", t).split())

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r for r in df.select("i", T.norm(F.col("t")).alias("n"), T.folded(F.col("t")).alias("f")).collect()}
    for i, t in enumerate(texts):
        assert (got[i].n, got[i].f) == ((None, None) if t is None else (norm(t), fold(t))), t


def test_decomposed_text_is_read(spark):
    n = sections.with_sections(note(spark, apart("Chẩn đoán: viêm phổi")))
    assert n.select("sections").first().sections[0].name == "diagnosis"
    t = terminology.terms(spark.createDataFrame([(1, "Rx1", "Đái tháo", "custom", "diagnosis", [], "v", "vi", None)], "ord long, concept_id string, name string, source string, semantic_type string, aliases array<string>, version string, language string, term_type string"))
    m = spark.createDataFrame([("m", apart("Đái tháo"), "diagnosis"), ("f", "dai thao", "diagnosis")], "mention_id string, mention string, concept_type string")
    assert [r.mention_id for r in terminology.lookup(m, terminology.exact_keys(t), t, T.norm(F.col("mention"))).collect()] == ["m"]
    assert {r.mention_id for r in terminology.lookup(m, terminology.folded_keys(t), t, T.folded(F.col("mention"))).collect()} == {"m", "f"}
    assert spark.range(1).select(assertion.has_cue(T.norm(F.lit(apart("không ghi nhận sốt"))), ["không ghi nhận"]).alias("x")).first().x


def test_windows_end_with_the_text(spark):
    for stop in ("\n", "\r", " "):
        raw = f"Abc def.{stop}ho khan nhiều"
        at = len("Abc def.") + 1
        row = spark.createDataFrame([(raw,)], "t string").select(*[c.alias(n) for n, c in zip("ab", sections.sentence_window(F.col("t"), F.lit(at), F.lit(at + 2)))], *[c.alias(n) for n, c in zip("cd", sections.clause_window(F.col("t"), F.lit(at), F.lit(at + 2)))]).first()
        left = stop if stop == "\n" else "." + stop
        assert (row.a, row.b) == (left, left + "ho khan nhiều")
        assert (row.c, row.d) == (("", "ho khan nhiều") if stop == "\n" else (stop, stop + "ho khan nhiều"))


def test_chunks_by_the_rule(spark):
    text = "\n".join("word%d one two, three; four. five" % i for i in range(40))
    got = sections.chunks(note(spark, text, " " * 200, "x" * 200), 80, 20).orderBy("record_id", "chunk_ord").collect()
    mine = [r for r in got if r.record_id == "r0"]
    assert all(text[r.start : r.start + len(r.text)] == r.text and len(r.text) <= 80 for r in mine)
    assert all(b.start <= a.start + len(a.text) and b.start > a.start for a, b in zip(mine, mine[1:]))
    assert all(text[r.start - 1].isspace() for r in mine[1:]) and not any(r.text.endswith("\n") for r in mine)
    assert [(r.start, len(r.text)) for r in got if r.record_id == "r2"] == [(0, 80), (80, 80), (160, 40)]
    assert len([r for r in got if r.record_id == "r1"]) > 2


def test_memory_lexicon_places(spark):
    lex = spark.createDataFrame([("phổi", "CHẨN_ĐOÁN", [], [], 9), ("Viêm phổi", "CHẨN_ĐOÁN", [], ["J18"], 3), ("ho", "X", [], [], 1)], "text string, type string, assertions array<string>, candidates array<string>, count int")
    n = note(spark, "İ VIÊM PHỔI và phổi", "ho", "", None, "ph")
    got = sorted((r.record_id, r.start, r.end, r.text) for r in extraction.memory_lexicon(n, lex).collect())
    assert got == [("r0", 2, 11, "VIÊM PHỔI"), ("r0", 15, 19, "phổi")]


def test_token_spans_join_over_a_blank_alone(spark):
    n = note(spark, "abcd,efgh", "abcd efgh", "abcdefgh")
    row = lambda r, a, b, s: (r, 0, a, b, "B-DISEASE", s)
    rows = [row("r0", 0, 4, 0.9), row("r0", 5, 9, 0.8), row("r1", 0, 4, 0.9), row("r1", 5, 9, 0.8), row("r2", 0, 5, 0.9), row("r2", 4, 8, 0.8), row("r2", 6, 20, 0.9)]
    t = spark.createDataFrame(rows, "record_id string, chunk_start int, start int, end int, label string, score double")
    got = sorted((r.record_id, r.start, r.end, r.confidence) for r in extraction.ner_spans(t, n).collect())
    assert got == [("r0", 0, 4, 0.9), ("r0", 5, 9, 0.8), ("r1", 0, 9, 0.8), ("r2", 0, 5, 0.9), ("r2", 4, 8, 0.8)]


def test_memory_of_records_without_entities(spark):
    rows = spark.createDataFrame([("r0", 1, "ho", "X", 0, 2, [], [])], "record_id string, ord int, text string, type string, start int, end int, assertions array<string>, candidates array<string>")
    n = note(spark, "ho khan", "khác")
    memory, _ = algebra.build_memory(rows, n, n.select("record_id"))
    assert {r.record_id: len(r.spans) for r in memory.collect()} == {"r0": 1, "r1": 0}


def test_remembered_notes(spark):
    n = note(spark, "đau ngực và ho khan", "đau ngực và ho khan", "đau ngực và ho khan")
    entity = "struct<text:string,position:array<int>,type:string,assertions:array<string>,candidates:array<string>>"
    sha = n.select(F.sha1(F.col("raw_text").cast("binary")).alias("s")).first().s
    held = [("đau", [0, 3], "TRIỆU_CHỨNG", ["isFamily"], [])]
    memory = spark.createDataFrame([("r0", sha, held), ("r1", "other", held)], f"record_id string, sha1 string, spans array<{entity}>")
    lex = spark.createDataFrame([("khan", "TRIỆU_CHỨNG", [], [], 2)], "text string, type string, assertions array<string>, candidates array<string>, count int")
    t = terminology.terms(readers.alias_terms(readers.builtin_aliases(spark)))
    out = infer(n, t, Plan(use_rules=False, fuzzy=False), memory=memory, lexicon=lex).select("record_id", "text", "source", "assertions").collect()
    got = sorted((r.record_id, r.text, r.source) for r in out)
    assert got == [("r0", "đau", "model_exact"), ("r1", "khan", "model_lexicon"), ("r2", "khan", "model_lexicon")]
    assert [r.assertions for r in out if r.record_id == "r0"] == [["isFamily"]]
