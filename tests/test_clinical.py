"""Golden cases of the clinical operators, and a plain specification of the overlap merge."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marginalia.functions import text as T
from marginalia.operators import algebra, assertion, extraction, llm_spans, sections, spans, terminology
from marginalia.plans.inference import Plan, documents, infer
from marginalia.sources import readers, writers


def notes(spark, *texts):
    return spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "record_id string, raw_text string")


def test_sections_of_headings(spark):
    raw = "Lý do nhập viện:\nĐau ngực\n\nTiền sử bệnh:\nTăng huyết áp"
    rows = sections.with_sections(notes(spark, raw, "", None)).collect()
    assert [s.name for s in rows[0].sections] == ["admission_reason", "past_history"]
    assert rows[0].sections[1].start <= raw.index("Tăng") < rows[0].sections[1].end
    assert [s.name for s in rows[1].sections] == ["unknown"]


def test_trim_and_offsets(spark):
    d = spark.createDataFrame([("  aspirin 325mg, ",)], "t string")
    a, b = T.trim_span(F.col("t"), F.lit(0), F.length("t"))
    assert d.select(T.cut(F.col("t"), a, b)).first()[0] == "aspirin 325mg"


def test_medication(spark):
    n = sections.with_sections(notes(spark, "BN đang dùng metoprolol 25mg po bid và aspirin."))
    got = {r.text for r in spans.resolved(extraction.rules(n), n).collect()}
    assert {"metoprolol 25mg po bid", "aspirin"} <= got


def test_lab_block(spark):
    raw = "Kết quả xét nghiệm:\n- Interleukin 6: 42 pg/mL\n- Cystatin C 1.4 mg/dL\nChẩn đoán hình ảnh:\n- Khối 12 cm"
    n = sections.with_sections(notes(spark, raw))
    got = {(r.text, r.concept_type) for r in extraction.structured_labs(n).collect()}
    assert got == {("Interleukin 6", "lab_test"), ("42 pg/mL", "lab_result"), ("Cystatin C", "lab_test"), ("1.4 mg/dL", "lab_result")}
    assert not {"K", "Khối"} & {r.text for r in extraction.labs(n).collect()}


def line(i, cui, tty, name, sab="RXNORM", suppress="N"):
    return (i, "|".join([cui, "ENG", "", "", "", "", "", "", "", "", "", sab, tty, "", name, "", suppress, "", ""]))


def drug_terms(spark, *rows):
    return terminology.terms(readers.rxnorm_rows(spark.createDataFrame([line(i, *r) for i, r in enumerate(rows)], "ord long, value string")))


def link(spark, t, mention, kind="drug"):
    m = spark.createDataFrame([("m", mention, kind)], "mention_id string, mention string, concept_type string")
    return terminology.ranked(terminology.candidates(m, t)).orderBy("rank").collect()


def test_builtin_alias(spark):
    t = terminology.terms(readers.alias_terms(readers.builtin_aliases(spark)))
    assert "Rx161" in {r.concept_id for r in link(spark, t, "tylenol")}


def test_rxnorm_dedup(spark):
    t = drug_terms(spark, ("315643", "SCDC", "Amlodipine 10 MG"), ("315643", "SCDC", "amlodipine 10 mg"), ("315643", "SY", "Amlodipine"))
    rows = t.collect()
    assert [(r.concept_id, r.version) for r in rows] == [("Rx315643", "2026-07-06")]


def test_strength_beats_ingredient(spark):
    t = drug_terms(spark, ("17767", "IN", "amlodipine"), ("308135", "SCD", "amlodipine 10 MG Oral Tablet"))
    assert link(spark, t, "amlodipine 10 mg po daily")[0].concept_id == "Rx308135"


def test_strength_range_takes_low_end(spark):
    t = drug_terms(spark, ("313782", "SCD", "acetaminophen 325 MG Oral Tablet"), ("198440", "SCD", "acetaminophen 650 MG Oral Tablet"))
    assert link(spark, t, "acetaminophen 325-650 mg po q6h:prn")[0].concept_id == "Rx313782"


def test_volume_is_no_strength_of_another_drug(spark):
    t = drug_terms(spark, ("373136", "SCDF", "nystatin Oral Suspension"), ("1", "SCD", "ibuprofen 100 MG in 5 ML Oral Suspension"))
    rows = link(spark, t, "nystatin oral suspension 5 ml po qid:prn")
    assert rows and rows[0].concept_id == "Rx373136"


def test_token_tier_is_dropped(spark):
    t = drug_terms(spark, ("1", "IN", "clopidogrel bisulfate"))
    rows = terminology.gated(terminology.ranked(terminology.candidates(spark.createDataFrame([("m", "some clopidogrel thing else", "drug")], "mention_id string, mention string, concept_type string"), t, fuzzy=False))).collect()
    assert rows == []


def test_fuzzy_ratio():
    assert terminology._set_ratio("viêm phổi", "phổi viêm") == 100.0
    assert terminology._set_ratio("a b", "a b c") == 100.0
    assert terminology._indel("kitten", "sitting") == pytest.approx(8 / 13)
    assert terminology._set_ratio("", "x") == 0.0


def test_llm_alignment(spark):
    n = notes(spark, "Bệnh nhân nói không ho và dùng aspirin.")
    body = json.dumps({"entities": [{"text": "không ho", "type": "TRIỆU_CHỨNG", "position": [14, 22], "assertions": ["isNegated"]}, {"text": "aspirin", "type": "THUỐC", "position": [0, 7], "assertions": []}]})
    rows = llm_spans.llm_spans(spark.createDataFrame([("0", body)], "record_id string, content string"), n).orderBy("start").collect()
    assert [(r.text, r.start, r.assertions) for r in rows] == [("không ho", 14, ["isNegated"]), ("aspirin", 31, [])]


def test_llm_labels_and_truncation():
    assert llm_spans._labels([{"value": "isNegated"}, {"type": "isFamily"}, "isHistorical"]) == ["isNegated", "isFamily", "isHistorical"]
    assert llm_spans._labels({"isNegated": True, "isFamily": False}) == ["isNegated"]
    cut = '{"entities":[{"text":"ho","type":"X"},{"text":"sốt {","type":"X"},{"text":"đau'
    assert [x["text"] for x in llm_spans._items(cut)] == ["ho", "sốt {"]
    assert llm_spans._items("nothing") == [] and llm_spans._items('{"entities": {"text": "a"}}') == [{"text": "a"}]


def test_llm_consensus_modes(spark):
    raw = "Kết quả xét nghiệm:\nCystatin C: bình thường\nĐiều trị:\nCystatin C: bình thường"
    n = notes(spark, raw)
    e = [("Cystatin C", "TÊN_XÉT_NGHIỆM"), ("bình thường", "KẾT_QUẢ_XÉT_NGHIỆM")]
    body = json.dumps({"entities": [{"text": t, "type": k, "position": [p := raw.index(t) if not late else raw.rindex(t), p + len(t)]} for late in (0, 1) for t, k in e]})
    model = llm_spans.llm_spans(spark.createDataFrame([("0", body)], "record_id string, content string"), n)
    assert model.count() == 4
    none = model.limit(0)
    assert llm_spans.consensus(model, none, n).count() == 0
    got = llm_spans.consensus(model, none, n, "consensus_structured_labs").collect()
    assert sorted(r.start for r in got) == [raw.index("Cystatin"), raw.index("bình")]
    assert llm_spans.consensus(model, model, n).count() == 4
    assert llm_spans.consensus(model, none, n, "augment").count() == 4


def test_budget():
    models = {"llm": {"enabled": True, "active_parameters_billion": 8.2}, "transformer_ner_models": [{"enabled": True, "active_parameters_billion": 0.278}]}
    assert readers.active_parameters({"models": models}) == pytest.approx(8.478)
    with pytest.raises(ValueError):
        readers.active_parameters({"models": models | {"parameter_budget_billion": 8}})


def test_config_merge():
    assert readers.merged_config({"a": {"x": 1, "y": 2}, "b": [1]}, {"a": {"y": 3}, "b": [2], "c": 4}) == {"a": {"x": 1, "y": 3}, "b": [2], "c": 4}


@pytest.mark.parametrize(("raw", "said"), [("Tiền sử bệnh:\nTăng huyết áp.", "isHistorical"), ("Không ghi nhận đau ngực.", "isNegated"), ("Mẹ bị tăng huyết áp.", "isFamily"), ("Có đau ngực.", "isPresent")])
def test_rule_assertions(spark, raw, said):
    n = sections.with_sections(notes(spark, raw))
    rows = extraction.symptom_lexicon(n).unionByName(extraction.diagnosis_lexicon(n))
    assert [r.a for r in assertion.in_context(rows, n).select(assertion.rule().alias("a")).collect()] == [said]


def overlap(a, b):
    inter = max(0, min(a[1], b[1]) - max(a[0], b[0]))
    hull = max(a[1], b[1]) - min(a[0], b[0])
    return inter / hull if hull else 0.0


def spec_merge(rows):
    """(start, end, type, confidence, text) in order; the merge as the survey words it."""
    best = {}
    for r in rows:
        if r[3] >= 0.65 and (r[:3] not in best or r[3] > best[r[:3]][3]):
            best[r[:3]] = r
    slots = []
    for r in sorted(best.values(), key=lambda r: (r[0], r[1], -r[3])):
        at = next((i for i, o in enumerate(slots) if overlap(r, o) > 0.5), None)
        if at is None:
            slots.append(r)
            continue
        o = slots[at]
        if r[2] == o[2] and abs(r[3] - o[3]) <= 0.08:
            wins = r[1] - r[0] >= o[1] - o[0]
        elif r[2] == "drug" and any(c.isdigit() for c in r[4]):
            wins = True
        elif o[2] == "drug" and any(c.isdigit() for c in o[4]):
            wins = False
        else:
            wins = r[3] >= o[3]
        slots[at] = r if wins else o
    return sorted(slots, key=lambda r: (r[0], r[1]))


span_row = st.tuples(st.integers(0, 8), st.integers(1, 8), st.sampled_from(["drug", "symptom", "diagnosis"]), st.sampled_from([0.6, 0.68, 0.72, 0.76, 0.8, 0.84, 0.92]), st.sampled_from(["a", "a1"]))


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(span_row, min_size=1, max_size=9), min_size=20, max_size=40))
def test_merge_matches_specification(spark, data):
    data = [[(s, s + n, k, c, t) for s, n, k, c, t in note] for note in data]
    rows = [(str(i), j, t, s, e, k, "isPresent", None, [], c, "x") for i, note in enumerate(data) for j, (s, e, k, c, t) in enumerate(note)]
    got = {}
    for r in spans.merged(spark.createDataFrame(rows, spans.SCHEMA)).orderBy("record_id", "gen_ord").collect():
        got.setdefault(int(r.record_id), []).append((r.start, r.end, r.concept_type, r.confidence, r.text))
    for i, note in enumerate(data):
        assert sorted(got.get(i, [])) == sorted(spec_merge(note)), note


def test_boundary_consensus_moves_memory(spark):
    row = lambda i, a, b, src, c: ("0", i, "x" * (b - a), a, b, "symptom", "isPresent", None, [], c, src)
    s = spark.createDataFrame([row(0, 0, 20, "model_exact", 0.995), row(1, 2, 8, "x_ner", 0.95), row(2, 2, 9, "symptom_lexicon", 0.7)], spans.SCHEMA)
    got = sorted((r.start, r.end, r.source) for r in spans.boundary_consensus(s).collect())
    assert got == [(2, 8, "model_exact"), (2, 9, "symptom_lexicon")]


def test_repair(spark):
    n = notes(spark, "xx abc yy abc", "xx abc yy")
    s = spark.createDataFrame([("0", "abc", 1, 4), ("1", "abc", 1, 4)], "record_id string, text string, start int, end int")
    assert [(r.record_id, r.start) for r in spans.repaired(s, n).collect()] == [("1", 3)]


def test_memory_round_trip(spark):
    n = sections.with_sections(notes(spark, "ho khan và sốt"))
    e = spark.createDataFrame([("0", 0, "ho khan", "TRIỆU_CHỨNG", 0, 7, ["isNegated"], [])], "record_id string, ord int, text string, type string, start int, end int, assertions array<string>, candidates array<string>")
    memory, lexicon = algebra.build_memory(e, n)
    got = extraction.remembered(n, memory).collect()
    assert [(r.text, r.confidence, r.assertions) for r in got] == [("ho khan", 0.995, ["isNegated"])]
    other = sections.with_sections(notes(spark, "khác: HO KHAN"))
    assert extraction.remembered(other, memory).count() == 0
    assert [r.text for r in extraction.memory_lexicon_spans(other, lexicon).collect()] == ["HO KHAN"]


def test_documents_keep_notes_without_spans(spark, tmp_path):
    n = notes(spark, "Chẩn đoán: viêm phổi. BN dùng aspirin.", "Hẹn lịch.")
    t = terminology.terms(readers.alias_terms(readers.builtin_aliases(spark)))
    docs = documents(n, t, Plan(fuzzy=False)).persist()
    got = {r.record_id: r.entities for r in docs.collect()}
    assert got["1"] == [] and {e.text for e in got["0"]} == {"viêm phổi", "aspirin"}
    assert [e.candidates for e in got["0"] if e.text == "viêm phổi"] == [["J18"]]
    assert algebra.violations(docs, n).count() == 0
    (tmp_path / "out.zip").write_bytes(writers.zip_bytes(docs))
    back = {r.record_id: r.entities for r in readers.read_results(spark, str(tmp_path / "out.zip")).collect()}
    assert back == got


def test_note_folder(spark, tmp_path):
    for name in ("10", "2", "x"):
        (tmp_path / f"{name}.txt").write_text(f"note {name}\nline", encoding="utf-8")
    rows = readers.read_notes(spark, str(tmp_path))
    assert [r.record_id for r in rows.orderBy(*readers.numeric_order(F.col("record_id"))).collect()] == ["2", "10", "x"]


def test_stream(spark, tmp_path):
    from marginalia.streaming.notes import stream_notes, stream_spans, write_spans

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.txt").write_text("dùng aspirin", encoding="utf-8")
    write_spans(stream_spans(stream_notes(spark, str(tmp_path / "in"))), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert [r.text for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["aspirin"]


def test_metrics(spark):
    d = spark.createDataFrame([("a b c", "a x c d"), ("", ""), ("", "a")], "a string, b string")
    rows = d.select(algebra.word_edit_distance("a", "b").alias("n"), algebra.word_error_rate(F.col("a"), F.col("b")).alias("r")).collect()
    assert [(r.n, r.r) for r in rows] == [(2, 2 / 3), (0, 0.0), (1, 1.0)]


def test_infer_empty(spark):
    t = terminology.terms(readers.alias_terms(readers.builtin_aliases(spark)))
    assert infer(notes(spark, "").limit(0), t, Plan(fuzzy=False)).count() == 0


def test_library_stands_without_llm():
    import subprocess
    import sys
    from pathlib import Path

    code = "import sys; sys.modules['marginalia.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; assert len(e.queries()) > 80; assert 'pipeline' not in e.queries()"
    assert subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[1]).returncode == 0


def test_queries_without_sql_read_whole_tables(spark, monkeypatch):
    from marginalia.plans.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = lambda t: spark.read.parquet(f"{sf}/{t}.parquet")
    ids = lambda q: {r.mention_id for r in QUERIES[q](spark, sf).select("mention_id").distinct().collect()}
    parts = {str(r.p_partkey) for r in rows("part").collect()}
    assert ids("f6_token_lookup") == parts and ids("f13_candidate_cascade") == parts
    assert ids("f8_fuzzy_lookup") == {str(r.s_suppkey) for r in rows("supplier").collect()}
    assert QUERIES["f15_contextual_score"](spark, sf).count() == rows("lineitem").count()
    # at least these are linked to a term of their own strength
    assert {p for p in parts if int(p) % 4 == 0} <= ids("f11_strength_candidates")
    seen = []
    train = assertion.train_classifiers
    monkeypatch.setattr(assertion, "train_classifiers", lambda d, *a: seen.append(d) or train(d, *a))
    QUERIES["h10_classifier_training"](spark, sf)
    want = rows("documents").join(rows("labels"), "doc_id")
    assert sorted(r.text or "" for r in seen[0].collect()) == sorted(r.text or "" for r in want.collect())
