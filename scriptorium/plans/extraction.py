"""Extraction layer over recorded model responses: normalise, validate, persist; drift statistics (FN-17 to FN-21, Q-09 to Q-16)."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.text import cluster_key
from ..registry import query

#: Allowed labels of claims.
ALLOWED = {
    "claim_type": ("definition", "thesis", "empirical", "normative", "methodological", "objection", "reply"),
    "polarity": ("assert", "deny", "conditional"),
    "modality": ("is", "will", "would", "can", "could", "cannot", "must", "should", "ought", "may", "appears_as", "becomes", "in_essence_is"),
    "dialectical_status": ("none", "tension_pair", "appearance_essence", "developmental"),
    "attribution": ("self", "citation", "interlocutor"),
}
TRUE, FALSE = ("true", "t", "yes", "y", "1"), ("false", "f", "no", "n", "0")


def token(value: Column) -> Column:
    return F.nullif(F.lower(F.trim(value)), F.lit(""))


def allowed(value: Column, kind: str) -> Column:
    """The normal label, or null for an unknown one."""
    return F.when(token(value).isin(*ALLOWED[kind]), token(value))


def raw_if_unknown(value: Column, kind: str) -> Column:
    return F.when(allowed(value, kind).isNull(), value)


def boolean(value: Column) -> Column:
    return F.when(token(value).isin(*TRUE), True).when(token(value).isin(*FALSE), False)


def confidence(value: Column) -> Column:
    number = F.trim(value).try_cast("double")
    return F.when(number.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), number)))


def first_json_object(text: str | None) -> str | None:
    """The first balanced object in a reply that parses, fences and prose around it left out."""
    at = (text or "").find("{")
    while at >= 0:
        try:
            value, end = json.JSONDecoder().raw_decode(text, at)
        except ValueError:
            at = text.find("{", at + 1)
            continue
        return text[at:end] if isinstance(value, dict) else None
    return None


@F.pandas_udf(StringType())
def json_object(replies: pd.Series) -> pd.Series:
    return replies.map(first_json_object)


CLAIMS = "claims array<struct<claim_text_canonical:string,claim_type:string,polarity:string,modality:string,dialectical_status:string,attribution:string,confidence:string,evidence_sentence_indices:array<string>>>"
MENTIONS = "mentions array<struct<surface_form:string,sentence_index:string,is_technical_term:string,normalized_form:string,confidence:string>>"


def claims(responses: DataFrame) -> DataFrame:
    """responses(key, reply, n_sentences) -> normal claims; without text or evidence they go; valid: indices in range."""
    rows = responses.select("key", "n_sentences", F.explode(F.from_json(json_object("reply"), CLAIMS)["claims"]).alias("c"))
    indices = F.filter(F.transform("c.evidence_sentence_indices", lambda s: F.trim(s).try_cast("int")), lambda i: i.isNotNull())
    rows = rows.withColumn("evidence", indices).filter((F.trim("c.claim_text_canonical") != "") & (F.size("evidence") > 0))
    labels = [e for k in ALLOWED for e in (allowed(F.col(f"c.{k}"), k).alias(k), raw_if_unknown(F.col(f"c.{k}"), k).alias(f"{k}_raw"))]
    valid = F.forall("evidence", lambda i: (i >= 0) & (i < F.col("n_sentences")))
    return rows.select("key", F.trim("c.claim_text_canonical").alias("claim_text"), "evidence", *labels, confidence(F.col("c.confidence")).alias("confidence"), valid.alias("valid"))


def mentions(responses: DataFrame) -> DataFrame:
    rows = responses.select("key", F.explode(F.from_json(json_object("reply"), MENTIONS)["mentions"]).alias("m"))
    at = F.trim("m.sentence_index").try_cast("int")
    rows = rows.filter((F.trim("m.surface_form") != "") & at.isNotNull())
    technical = boolean(F.col("m.is_technical_term"))
    return rows.select("key", F.col("m.surface_form").alias("surface_form"), at.alias("sentence_index"), technical.alias("is_technical"), F.when(technical.isNull(), F.col("m.is_technical_term")).alias("is_technical_raw"), confidence(F.col("m.confidence")).alias("confidence"), cluster_key(F.coalesce("m.normalized_form", "m.surface_form")).alias("cluster"))


def _pick(*values: str) -> Column:
    """One of the values in turn, by event."""
    return F.element_at(F.array(*map(F.lit, values)), (F.col("event_id") % len(values) + 1).cast("int"))


def recorded(t) -> DataFrame:
    """Recorded replies, one an event: fenced JSON with known, unknown and malformed labels."""
    claim = F.concat(
        F.lit('{"claim_text_canonical": "'), _pick("All is flux", " ", "Value is labour"), F.lit('", "claim_type": "'), _pick("Thesis", "slogan", "empirical", "reply"), F.lit('", "polarity": "'), _pick("assert", "DENY", "maybe"),
        F.lit('", "modality": "'), _pick("is", "might", "must"), F.lit('", "dialectical_status": "'), _pick("none", "other"), F.lit('", "attribution": "'), _pick("self", "citation", "crowd"),
        F.lit('", "confidence": "'), _pick("0.5", "7", "x"), F.lit('", "evidence_sentence_indices": ['), _pick("0", "", "1, \"2\"", "9"), F.lit("]}"),
    )
    mention = F.concat(F.lit('{"surface_form": "'), _pick("Surplus Value", "", "Labour-power!"), F.lit('", "sentence_index": "'), _pick("0", "one", "2"), F.lit('", "is_technical_term": "'), _pick("yes", "No", "unsure"), F.lit('", "confidence": "0.8"}'))
    reply = F.concat(F.lit("Here it is:\n```json\n{\"claims\": ["), claim, F.lit('], "mentions": ['), mention, F.lit("]}\n```"))
    return t.events.select(F.col("event_id").alias("key"), "event_id", reply.alias("reply"), F.lit(3).alias("n_sentences"))


_E = "FROM events WHERE event_id % 3 <> 1 AND event_id % 4 <> 1"


@query("fn17_claims", f"SELECT event_id AS key, CASE event_id % 3 WHEN 0 THEN 'All is flux' ELSE 'Value is labour' END AS claim_text, CASE event_id % 4 WHEN 0 THEN 'thesis' WHEN 2 THEN 'empirical' ELSE 'reply' END AS claim_type, CASE event_id % 3 WHEN 0 THEN 'assert' END AS polarity, CASE event_id % 3 WHEN 0 THEN 0.5 END::DOUBLE AS confidence, event_id % 4 <> 3 AS valid {_E}")
def claim_rows(t):
    return claims(recorded(t)).select("key", "claim_text", "claim_type", "polarity", "confidence", "valid")


@query("fn17_mentions", "SELECT event_id AS key, CASE event_id % 3 WHEN 0 THEN 'surplus value' ELSE 'labour-power' END AS cluster, CASE event_id % 3 WHEN 0 THEN true END AS is_technical, CASE event_id % 3 WHEN 2 THEN 'unsure' END AS is_technical_raw FROM events WHERE event_id % 3 <> 1")
def mention_rows(t):
    return mentions(recorded(t)).select("key", "cluster", "is_technical", "is_technical_raw")


def drift(rows: DataFrame, canonical: str, raw: str, k: int = 50) -> DataFrame:
    """Unknown labels by frequency: canonical null, raw present."""
    unknown = rows.filter(F.col(canonical).isNull() & F.col(raw).isNotNull())
    return unknown.groupBy(F.col(raw).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(k)


def _drift_sql(values: str, known: str) -> str:
    n = values.count(",") + 1
    return f"SELECT [{values}][event_id % {n} + 1] AS value, count(*) AS n {_E} AND lower([{values}][event_id % {n} + 1]) NOT IN ({known}) GROUP BY 1 ORDER BY n DESC, value LIMIT 50"


for _name, _kind, _values in (("q11_modality_stats", "modality", "'is', 'might', 'must'"), ("q13_claim_type_stats", "claim_type", "'Thesis', 'slogan', 'empirical', 'reply'"), ("q14_polarity_stats", "polarity", "'assert', 'DENY', 'maybe'"), ("q15_dialectical_stats", "dialectical_status", "'none', 'other'"), ("q16_attribution_stats", "attribution", "'self', 'citation', 'crowd'")):
    query(_name, _drift_sql(_values, ", ".join(f"'{a}'" for a in ALLOWED[_kind])))(lambda t, kind=_kind: drift(claims(recorded(t)), kind, f"{kind}_raw"))


@query("q12_technicality_stats", "SELECT 'unsure' AS value, count(*) AS n FROM events WHERE event_id % 3 = 2 GROUP BY 1")
def technicality(t):
    return drift(mentions(recorded(t)), "is_technical", "is_technical_raw")


@query("q09_inspect_edition", f"SELECT user_id, count(*) AS claims, count(*) FILTER (event_id % 4 <> 3) AS valid FROM (SELECT * {_E}) GROUP BY 1")
def inspect(t):
    rows = claims(recorded(t)).join(t.events.select(F.col("event_id").alias("key"), "user_id"), "key")
    return rows.groupBy("user_id").agg(F.count("*").alias("claims"), F.count_if("valid").alias("valid"))


@query("q10_sample_edition")
def sample(t, n: int = 20, seed: int = 11):
    """Paragraphs without mentions, in seeded random order."""
    done = mentions(recorded(t)).select("key").distinct()
    left = t.events.select(F.col("event_id").alias("key")).join(done, "key", "left_anti")
    return left.orderBy(F.xxhash64(F.lit(seed), "key"), "key").limit(n)


@query(
    "stage_b_concepts",
    "SELECT c AS concept, count(*) AS mentions, min(k) AS first_mention FROM (SELECT event_id AS k, CASE event_id % 3 WHEN 0 THEN 'surplus value' ELSE 'labour-power' END AS c FROM events WHERE event_id % 3 <> 1) GROUP BY 1 HAVING count(*) >= 2",
)
def concepts(t):
    """Mentions clustered by key, clusters of two or more, each mention assigned once."""
    return mentions(recorded(t)).groupBy(F.col("cluster").alias("concept")).agg(F.count("*").alias("mentions"), F.min("key").alias("first_mention")).filter("mentions >= 2 AND concept <> ''")
