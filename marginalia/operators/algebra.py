"""Algebra of result sets, one row for each entity (record_id, ord, text, type, start, end, assertions, candidates)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from ..functions import lexicons as L
from ..functions import text as T
from .extraction import first_of_each, found
from .spans import uncovered

KEY = ["record_id", "start", "end", "type"]
_VALUE = r"[<>]?[ \t]*\d+(?:[,.]\d+)?(?:[ \t]*(?:%|mg/dL|mmol/L|µmol/L|umol/L|g/L|g/dL|U/L|IU/L|ng/L|ng/mL|pg/mL|mEq/L|mmHg|10\^9/L|10\^12/L|K/uL|M/uL))?"
_LINKED = [L.TYPE_LABELS["diagnosis"], L.TYPE_LABELS["drug"]]
_LAB_TYPES = ["TÊN_XÉT_NGHIỆM", "KẾT_QUẢ_XÉT_NGHIỆM"]


def strict_lab_pairs(rows: DataFrame, notes: DataFrame) -> DataFrame:
    """H1: rows and the names and values of strict laboratory pairs that no entity of their type covers; of the added
    ones, those inside an earlier one go too."""
    pat = rf"(?iud)(?<![A-Za-z0-9])(?<n>(?:{T.alternatives(L.LABS + L.STRICT_LABS)})(?:[ \t]*\([^():;\n]{{1,90}}\))?)(?<m>[ \t]*(?:(?:là|bằng|đạt|:|：|=)[ \t]*)?)(?<v>{_VALUE})(?![.,]\d|[A-Za-z0-9])"
    parts = []
    for kind, marked in ((_LAB_TYPES[0], f"{T.OPEN}${{n}}{T.CLOSE}${{m}}${{v}}"), (_LAB_TYPES[1], f"${{n}}${{m}}{T.OPEN}${{v}}{T.CLOSE}")):
        parts.append(found(notes.select("record_id", "raw_text"), pat, marked).select("record_id", "gen_ord", F.col("hit").alias("text"), F.lit(kind).alias("type"), "start", "end"))
    new = uncovered(parts[0].unionByName(parts[1]), rows)
    held = new.select("record_id", "type", F.col("start").alias("h0"), F.col("end").alias("h1"), F.col("gen_ord").alias("h"))
    new = new.join(held, ["record_id", "type"], "left").groupBy("record_id", "gen_ord", "text", "type", "start", "end").agg(F.max(F.coalesce(F.expr("h < gen_ord AND h0 <= start AND end <= h1"), F.lit(False))).alias("inside")).where("NOT inside")
    none = F.array().cast("array<string>")
    return rows.unionByName(new.select("record_id", (F.col("gen_ord") + 1_000_000).alias("ord"), "text", "type", "start", "end", none.alias("assertions"), none.alias("candidates")))


def type_report(rows: DataFrame) -> DataFrame:
    """H2: counts of each type: entities, empty candidate lists (of the linked types), each assertion."""
    said = [F.sum(F.array_contains("assertions", a).cast("long")).alias(a) for a in L.OUTPUT_ASSERTIONS]
    return rows.groupBy("type").agg(F.count("*").alias("entities"), F.sum((F.col("type").isin(_LINKED) & (F.size("candidates") == 0)).cast("long")).alias("without_candidates"), *said)


def findings(rows: DataFrame, notes: DataFrame) -> DataFrame:
    """H2: (record_id, start, end, finding): a border inside a word, a trailing fragment, a line feed inside, an overlap
    with the next entity."""
    nxt = F.lead("start").over(Window.partitionBy("record_id").orderBy("start", "end", "type", "ord"))
    j = rows.withColumn("_next", nxt).join(notes.select("record_id", "raw_text"), "record_id")
    at = lambda c: F.substring(F.col("raw_text"), c, F.lit(1))
    word = L.AUDIT_WORD
    tests = {
        "midword_left": (F.col("start") > 0) & at(F.col("start")).rlike(word) & at(F.col("start") + 1).rlike(word),
        "midword_right": at(F.col("end")).rlike(word) & at(F.col("end") + 1).rlike(word),
        "trailing_fragment": F.col("text").rlike(L.TRAILING_FRAGMENT),
        "contains_newline": F.col("text").contains("\n"),
        "overlaps_next": F.col("_next") < F.col("end"),
    }
    each = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in tests.items()]))
    return j.select("record_id", "start", "end", "type", F.explode(each).alias("finding"))


def uncovered_terms(rows: DataFrame, notes: DataFrame) -> DataFrame:
    """H2: (record_id, type, start, end, text): symptoms and laboratory names in the notes that no entity of their type
    holds."""
    texts = notes.select("record_id", "raw_text")
    hits = [found(texts, T.whole_word(terms)).select("record_id", F.lit(kind).alias("type"), "start", "end", F.col("hit").alias("text")) for kind, terms in ((L.TYPE_LABELS["symptom"], L.SYMPTOMS), (_LAB_TYPES[0], L.LABS))]
    return uncovered(hits[0].unionByName(hits[1]), rows)


def expanded_labs(rows: DataFrame, other: DataFrame, reach: int = 24) -> DataFrame:
    """H3: names of laboratory tests take text and end of the shortest one of `other` that starts at the same place, is
    longer by up to `reach` characters, begins with their text whatever its case, and holds no line feed, semicolon or
    colon; then the first of each place and type."""
    name = F.col("type") == _LAB_TYPES[0]
    o = other.where(name & ~F.col("text").rlike("[\n;:]")).select("record_id", "start", F.col("end").alias("o_end"), F.col("text").alias("o_text"), F.col("ord").alias("o_ord"))
    j = rows.where(name).join(o, ["record_id", "start"]).where((F.col("o_end") > F.col("end")) & (F.col("o_end") - F.col("end") <= reach) & F.lower("o_text").startswith(F.lower("text")))
    best = j.groupBy("record_id", "ord").agg(F.min_by(F.struct("o_end", "o_text"), F.struct("o_end", "o_ord")).alias("b"))
    out = rows.join(best, ["record_id", "ord"], "left").withColumns({"end": F.coalesce("b.o_end", "end"), "text": F.coalesce("b.o_text", "text")}).drop("b")
    return first_of_each(out.withColumns({"gen_ord": F.col("ord"), "concept_type": F.col("type")})).select(*rows.columns)


def ablated(rows: DataFrame, strict: DataFrame, labels: list[str]) -> DataFrame:
    """H4: listed labels go unless the strict side (the last of equal entities) has them for the same entity; types
    other than symptoms, diagnoses and drugs lose all."""
    s = strict.groupBy(*KEY, "text").agg(F.max_by("assertions", "ord").alias("_s"))
    j = rows.join(s, [*KEY, "text"], "left")
    drop, none = F.array(*[F.lit(x) for x in labels]), F.array().cast("array<string>")
    kept = F.filter("assertions", lambda a: ~F.array_contains(drop, a) | F.array_contains(F.coalesce("_s", none), a))
    said = F.col("type").isin(L.TYPE_LABELS["symptom"], *_LINKED)
    return j.withColumn("assertions", F.when(said, kept).otherwise(none)).select(*rows.columns)


def projected_candidates(rows: DataFrame, donor: DataFrame, preserve: list[str] | None = None) -> DataFrame:
    """H5: candidates of the donor's entity with the same place and text (the last of equal ones), else of the one of
    that type that contains or is contained with the largest overlap, then the closest length, then the first; without
    any only types to preserve (drugs by default) keep theirs. Types other than diagnoses and drugs lose all."""
    none = F.array().cast("array<string>")
    same = donor.groupBy(*KEY, "text").agg(F.max_by("candidates", "ord").alias("_same"))
    d = donor.select("record_id", "type", F.col("start").alias("d0"), F.col("end").alias("d1"), F.col("candidates").alias("dc"), F.col("ord").alias("do"))
    size = F.least("end", "d1") - F.greatest("start", "d0")
    near = rows.where(F.col("type").isin(_LINKED)).join(d, ["record_id", "type"]).where("(d0 <= start AND end <= d1) OR (start <= d0 AND d1 <= end)").where(size > 0)
    best = near.groupBy("record_id", "ord").agg(F.max_by("dc", F.struct(size, -F.abs((F.col("end") - F.col("start")) - (F.col("d1") - F.col("d0"))), -F.col("do"))).alias("_near"))
    j = rows.join(same, [*KEY, "text"], "left").join(best, ["record_id", "ord"], "left")
    keep = F.when(F.col("type").isin([L.TYPE_LABELS["drug"]] if preserve is None else preserve), F.col("candidates"))
    return j.withColumn("candidates", F.when(F.col("type").isin(_LINKED), F.coalesce("_same", "_near", keep, none)).otherwise(none)).select(*rows.columns)


def canonical_drug_names(rows: DataFrame) -> DataFrame:
    """H6's names (name, ids, first): of the drugs that are one word of letters, the shortest, then first in order, of
    each code; up to two codes of a name, in the order of the entities."""
    text = F.lower(F.trim("text"))
    d = rows.where((F.col("type") == L.TYPE_LABELS["drug"]) & text.rlike(L.DRUG_TOKEN)).select(F.posexplode("candidates").alias("i", "id"), text.alias("name"), F.struct("record_id", "ord").alias("at"))
    best = d.groupBy("id").agg(F.min_by("name", F.struct(F.length("name"), F.col("name"))).alias("name"), F.min(F.struct("at", "i")).alias("first"))
    ids = F.slice(F.transform(F.array_sort(F.collect_list(F.struct("first", "id"))), lambda x: x["id"]), 1, 2)
    return best.groupBy("name").agg(ids.alias("ids"), F.min("first").alias("first"))


def split_drugs(rows: DataFrame, names: DataFrame, terms: DataFrame | None = None, notes: DataFrame | None = None) -> DataFrame:
    """H6: rows with `piece`. In the first word of a drug the known names are found, longest first, none overlapping an
    earlier one (a fold in the entity); gaps of five letters or more that `terms` knows as drugs are names too. A word
    of several names, or that only begins with one, becomes an entity for each, historical where section or context
    (`notes` with sections) say so. Then the first of each place and type."""
    word = F.regexp_extract("text", r"(?U)^\s*(\S+)", 1)
    drugs = rows.where(F.col("type") == L.TYPE_LABELS["drug"]).withColumn("low", F.lower(word)).where(F.length("low") >= 5)
    known = names.select("name", "ids", "first", F.length("name").alias("n"), F.substring("name", 1, 5).alias("head"))
    at = drugs.select("record_id", "ord", "low", F.explode(F.sequence(F.lit(1), F.length("low") - 4)).alias("i")).withColumn("head", F.expr("substring(low, i, 5)"))
    hit = at.join(known, "head").where(F.expr("substring(low, i, n) = name"))
    per = hit.groupBy("record_id", "ord").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "first", (F.col("i") - 1).alias("s"), (F.col("i") - 1 + F.col("n")).alias("e"), "ids"))).alias("h"))
    fold = "aggregate(h, slice(h, 1, 0), (acc, x) -> CASE WHEN exists(acc, o -> greatest(o.s, x.s) < least(o.e, x.e)) THEN acc ELSE concat(acc, array(x)) END)"
    none = "cast(array() AS array<struct<s:int,e:int,ids:array<string>>>)"
    m = drugs.select("record_id", "ord", "low").join(per, ["record_id", "ord"], "left").withColumn("m", F.expr(f"coalesce(array_sort(transform({fold}, x -> named_struct('s', x.s, 'e', x.e, 'ids', x.ids))), {none})"))
    if terms is not None:
        gaps = F.expr("filter(zip_with(concat(array(0), m.e), concat(m.s, array(length(low))), (a, b) -> named_struct('s', a, 'e', b)), g -> g.e - g.s >= 5)")
        free = m.select("record_id", "ord", "low", F.explode(gaps).alias("g")).withColumn("key", T.norm(F.expr("substring(low, g.s + 1, g.e - g.s)")))
        t = terms.where((F.col("source") == "RxNorm") | (F.col("semantic_type") == "drug")).select(F.col("norm").alias("key"), "term_ord", F.regexp_replace("concept_id", "^Rx", "").alias("id"))
        t = t.groupBy("key", "id").agg(F.min("term_ord").alias("o")).groupBy("key").agg(F.slice(F.transform(F.array_sort(F.collect_list(F.struct("o", "id"))), lambda x: x["id"]), 1, 2).alias("ids"))
        more = free.join(t, "key").groupBy("record_id", "ord").agg(F.collect_list(F.struct("g.s", "g.e", "ids")).alias("more"))
        m = m.join(more, ["record_id", "ord"], "left").withColumn("m", F.expr(f"array_sort(concat(m, coalesce(more, {none})))"))
    m = m.where("size(m) > 1 OR exists(m, x -> x.s = 0 AND x.e < length(low))").select("record_id", "ord", "m")
    j = rows.join(m, ["record_id", "ord"], "left")
    if notes is not None:
        from .sections import section_of

        j = j.join(notes.select("record_id", "raw_text", "sections"), "record_id", "left")
        context = lambda back, ahead: T.norm(T.cut(F.col("raw_text"), F.greatest(F.col("start") - back, F.lit(0)), ahead))
        holds = lambda text, cues: F.exists(F.array(*[T.norm(F.lit(c)) for c in cues]), lambda c: text.contains(c))
        past = section_of(F.col("sections"), F.col("start"), F.col("end")).isin("past_history", "medication_history") | holds(context(240, F.least(F.length("raw_text"), F.col("end") + 100)), L.HISTORICAL_CONTEXT) | holds(context(900, F.col("start")), L.HISTORICAL_HEADING)
        j = j.withColumn("_past", F.coalesce(past, F.lit(False)))
    else:
        j = j.withColumn("_past", F.lit(False))
    one = F.struct(F.lit(0).alias("s"), (F.col("end") - F.col("start")).cast("int").alias("e"), F.col("candidates").alias("ids"))
    j = j.withColumn("_cut", F.col("m").isNotNull()).select("*", F.posexplode(F.coalesce("m", F.array(one))).alias("piece", "x"))
    out = j.withColumns({
        "text": F.when(F.col("_cut"), T.cut(F.col("text"), F.col("x.s"), F.col("x.e"))).otherwise(F.col("text")),
        "end": F.when(F.col("_cut"), F.col("start") + F.col("x.e")).otherwise(F.col("end")),
        "start": F.when(F.col("_cut"), F.col("start") + F.col("x.s")).otherwise(F.col("start")),
        "assertions": F.when(F.col("_cut") & F.col("_past"), F.array(F.lit("isHistorical"))).otherwise(F.col("assertions")),
        "candidates": F.when(F.col("_cut"), F.slice(F.col("x.ids"), 1, 2)).otherwise(F.col("candidates")),
    })
    return first_of_each(out.withColumns({"gen_ord": F.struct("ord", "piece"), "concept_type": F.col("type")})).select(*rows.columns, "piece")


def restored(rows: DataFrame, origin: DataFrame, fields: list[str]) -> DataFrame:
    """H7: chosen list fields from the entity of `origin` at the same place and text, where there is one."""
    o = origin.groupBy(*KEY, "text").agg(*[F.first(f).alias(f"_{f}") for f in fields])
    return rows.join(o, [*KEY, "text"], "left").withColumns({f: F.coalesce(f"_{f}", f) for f in fields}).select(*rows.columns)


def build_memory(rows: DataFrame, notes: DataFrame, labelled: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """H8: (memory by record, lexicon by majority, most frequent first). `labelled` (record_id) names the records of the
    result set, those without an entity included; without it they are those of the rows. Entities whose text stands at their place are remembered with the
    SHA-1 of the note; of all payloads of one lower-cased text the most frequent wins, the first seen of equal ones."""
    j = rows.join(notes.select("record_id", "raw_text"), "record_id")
    ok = j.where((F.col("start") >= 0) & (F.col("start") < F.col("end")) & (F.col("end") <= F.length("raw_text")) & (T.cut(F.col("raw_text"), F.col("start"), F.col("end")) == F.col("text")))
    entity = F.struct("text", F.array("start", "end").alias("position"), "type", "assertions", "candidates")
    spans = ok.groupBy("record_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", entity.alias("e")))), lambda x: x["e"]).alias("spans"))
    seen = (rows if labelled is None else labelled).select("record_id").distinct().join(notes, "record_id").select("record_id", F.sha1(F.col("raw_text").cast("binary")).alias("sha1"))
    memory = seen.join(spans, "record_id", "left").select("record_id", "sha1", F.coalesce("spans", F.array().cast("array<struct<text:string,position:array<int>,type:string,assertions:array<string>,candidates:array<string>>>")).alias("spans"))
    payload = ["text", "type", "assertions", "candidates"]
    votes = ok.groupBy(*payload).agg(F.count("*").alias("count"), F.min(F.struct("record_id", "ord")).alias("first"))
    w = Window.partitionBy(F.lower("text")).orderBy(F.desc("count"), "first")
    lexicon = votes.withColumn("_n", F.row_number().over(w)).where("_n = 1").select(*payload, "count").orderBy(F.desc("count"), F.lower("text"))
    return memory, lexicon


def icd_aliases(rows: DataFrame) -> DataFrame:
    """H9: an alias row for each (lower text, code) of diagnoses, the last spelling winning."""
    d = rows.where(F.col("type") == L.TYPE_LABELS["diagnosis"]).select("record_id", "ord", F.trim("text").alias("t"), F.posexplode("candidates").alias("i", "c")).withColumn("c", F.trim("c")).where("t <> '' AND c <> ''")
    out = d.groupBy(F.lower("t").alias("k"), "c").agg(F.max_by("t", F.struct("record_id", "ord", "i")).alias("alias"))
    return out.select("alias", F.col("alias").alias("canonical"), F.concat(F.lit("ICD10:"), "c").alias("concept_id"), F.lit("ICD10_VI").alias("source"), F.lit("diagnosis").alias("semantic_type"))


# Metrics


def scores(predicted: DataFrame, gold: DataFrame) -> DataFrame:
    """Precision, recall, F1 and Jaccard of the distinct (record, start, end, type)."""
    p, g = (d.select(*KEY).distinct().withColumn(n, F.lit(1)) for d, n in ((predicted, "p"), (gold, "g")))
    c = p.join(g, KEY, "full").agg(F.count("p").alias("predicted"), F.count("g").alias("gold"), F.coalesce(F.sum(F.col("p") * F.col("g")), F.lit(0)).cast("long").alias("hits"))
    div = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    c = c.withColumns({"precision": div(F.col("hits"), F.col("predicted")), "recall": div(F.col("hits"), F.col("gold"))})
    union = F.col("predicted") + F.col("gold") - F.col("hits")
    return c.withColumns({"f1": div(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), "jaccard": F.when(union == 0, 1.0).otherwise(F.col("hits") / F.when(union > 0, union))})


def jaccard(a, b):
    """Of two arrays as sets; 1 where both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.when(union > 0, union))


@F.pandas_udf(IntegerType())
def word_edit_distance(a: pd.Series, b: pd.Series) -> pd.Series:
    """Insertions, deletions and replacements of words."""

    def one(x: str, y: str) -> int:
        x, y = x.split(), y.split()
        row = list(range(len(y) + 1))
        for i, p in enumerate(x, 1):
            diagonal, row[0] = row[0], i
            for j, q in enumerate(y, 1):
                diagonal, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diagonal + (p != q))
        return row[-1]

    return pd.Series([one(p or "", q or "") for p, q in zip(a, b)], dtype="int32")


def word_error_rate(reference, hypothesis):
    """I4: the distance over the words of the reference; of an empty reference 0 or 1."""
    n = F.size(F.filter(F.split(reference, r"(?U)\s+"), lambda x: x != ""))
    m = F.size(F.filter(F.split(hypothesis, r"(?U)\s+"), lambda x: x != ""))
    return F.when(n == 0, F.when(m == 0, 0.0).otherwise(1.0)).otherwise(word_edit_distance(reference, hypothesis) / F.when(n > 0, n))


def violations(results: DataFrame, notes: DataFrame, most: int = 2) -> DataFrame:
    """(record_id, rule) for everything in (record_id, entities) that the output contract forbids; empty if valid."""
    ids = notes.select("record_id")
    files = ids.join(results, "record_id", "left_anti").select("record_id", F.lit("missing_record").alias("rule")).union(results.join(ids, "record_id", "left_anti").select("record_id", F.lit("unknown_record")))
    e = results.join(notes.select("record_id", "raw_text"), "record_id").select("record_id", "raw_text", F.posexplode("entities").alias("i", "e"))
    p = F.col("e.position")
    known, kinds = F.array(*[F.lit(x) for x in L.OUTPUT_ASSERTIONS]), list(L.TYPE_LABELS.values())
    placed = (F.size(p) == 2) & (p[0] >= 0) & (p[0] < p[1]) & (p[1] <= F.length("raw_text"))
    rules = {
        "missing_field": F.col("e.text").isNull() | p.isNull() | F.col("e.type").isNull() | F.col("e.assertions").isNull() | F.col("e.candidates").isNull(),
        "bad_position": ~placed,
        "text_mismatch": placed & (T.cut(F.col("raw_text"), p[0], p[1]) != F.col("e.text")),
        "bad_type": ~F.col("e.type").isin(kinds),
        "bad_assertion": (F.size("e.assertions") > 3) | F.exists("e.assertions", lambda a: ~F.array_contains(known, a)),
        "too_many_candidates": F.size("e.candidates") > most,
        "candidates_on_type": (F.size("e.candidates") > 0) & ~F.col("e.type").isin(L.TYPE_LABELS["diagnosis"], L.TYPE_LABELS["drug"]),
    }
    each = e.select("record_id", F.explode(F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(n == "missing_field")), F.lit(n)) for n, c in rules.items()]))).alias("rule"))
    twice = e.groupBy("record_id", p[0].alias("a"), p[1].alias("b"), F.col("e.type").alias("t")).agg(F.count("*").alias("n")).where("n > 1").select("record_id", F.lit("duplicate_span").alias("rule"))
    return files.union(each).union(twice)


def error_report(predicted: DataFrame, gold: DataFrame) -> DataFrame:
    """I8: each place of either side as hit, spurious or missed; a place of both with other types is a type error."""
    p = predicted.select("record_id", "start", "end", F.col("type").alias("p_type")).distinct()
    g = gold.select("record_id", "start", "end", F.col("type").alias("g_type")).distinct()
    j = p.join(g, ["record_id", "start", "end"], "full")
    return j.select("record_id", "start", "end", "p_type", "g_type", F.when(F.col("p_type").isNull(), "missed").when(F.col("g_type").isNull(), "spurious").when(F.col("p_type") == F.col("g_type"), "hit").otherwise("type_error").alias("outcome"))
