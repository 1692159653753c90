"""The batch plan: notes to entity documents. One shuffle of the notes by record_id serves all folds and joins."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import assertion, extraction, llm_spans, spans, terminology
from ..operators.sections import with_sections


@dataclass
class Plan:
    """Settings with the reference defaults."""

    min_confidence: float = 0.65
    max_candidates: int = 2
    high: float = 0.88
    medium: float = 0.72
    fuzzy: bool = True
    use_context: bool = False
    augment_model_candidates: bool = False
    use_rules: bool = True
    llm_mode: str = "consensus"
    scope_repair: bool = True
    preserve_exact: bool = True
    enrich_exact: bool = False
    ensemble_exact: bool = False
    drug_names: list[str] = field(default_factory=list)
    diagnosis_names: list[str] = field(default_factory=list)


def infer(notes: DataFrame, terms: DataFrame, plan: Plan = Plan(), memory: DataFrame | None = None, lexicon: DataFrame | None = None, responses: DataFrame | None = None, ner: DataFrame | None = None, classified: DataFrame | None = None) -> DataFrame:
    """Spans of all notes: memory, lexicon and token models first, then rules, then the language model; merged twice,
    filtered, linked, filtered, asserted, repaired. Memory knows a note by its id and the SHA-1 of its text: such a note
    gets neither the lexicon nor, unless `ensemble_exact` is set, token models; all others do. Where `preserve_exact` is
    set, notes that have remembered spans and no others from a model keep exactly those, untouched, or with
    `enrich_exact` linked, asserted and repaired. With models and without rules nothing is merged or filtered."""
    notes = with_sections(notes.where("raw_text IS NOT NULL")).repartition("record_id").persist()
    ids = lambda d: d.select("record_id").distinct()
    parts, fresh, exact = [], notes, None
    if memory is not None:
        exact = extraction.remembered(notes, memory)
        same = notes.select("record_id", F.sha1(F.col("raw_text").cast("binary")).alias("sha1")).join(memory.select("record_id", "sha1"), ["record_id", "sha1"], "left_semi")
        fresh = notes.join(ids(same), "record_id", "left_anti")
        parts.append(exact)
    if ner is not None:
        ner = ner if plan.ensemble_exact else ner.join(ids(fresh), "record_id", "left_semi")
        parts.append(ner)
    if lexicon is not None:
        parts.append(extraction.memory_lexicon_spans(fresh, lexicon))
    rest, kept = notes, None
    if plan.preserve_exact and exact is not None:
        held = ids(exact)
        held = held.join(ids(ner), "record_id", "left_anti") if ner is not None else held
        kept = exact.join(held, "record_id", "left_semi")
        rest = notes.join(held, "record_id", "left_anti")
        parts = [p.join(held, "record_id", "left_anti") for p in parts]
    bare = bool(parts) and not plan.use_rules
    if plan.use_rules:
        parts.append(extraction.rules(rest, plan.drug_names, plan.diagnosis_names))
    # kept between the phases, each of which reads its input several times; a lost block is computed again
    every = (extraction.union(*parts) if parts else spark_empty(notes)).persist()
    if responses is not None:
        local = every
        every = local.unionByName(llm_spans.consensus(llm_spans.llm_spans(responses, rest), local, notes, plan.llm_mode))
    link = lambda d: terminology.linked(d.persist(), terms, plan.max_candidates, plan.augment_model_candidates, plan.fuzzy, notes, plan.use_context, plan.high, plan.medium)
    if not bare:
        every = spans.with_value(spans.resolved(every, notes, plan.min_confidence, ner is not None))
    out = link(every)
    out = (out if bare else spans.with_value(out)).persist()
    out = spans.repaired(assertion.asserted(out, notes, plan.scope_repair, classified), notes)
    if kept is None:
        return out
    if plan.enrich_exact:
        kept = spans.repaired(assertion.asserted(link(kept).persist(), notes, plan.scope_repair, classified), notes)
    return out.unionByName(kept.select(*out.columns))


def spark_empty(notes: DataFrame) -> DataFrame:
    """No span rows."""
    return notes.sparkSession.createDataFrame([], spans.SCHEMA)


def documents(notes: DataFrame, terms: DataFrame, plan: Plan = Plan(), **sources) -> DataFrame:
    """(record_id, entities) of every note, those without spans included."""
    return spans.documents(spans.entities(infer(notes, terms, plan, **sources)), notes)
