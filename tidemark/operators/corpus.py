"""Scope dispositions, the frozen corpus and its coverage ledger."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates, payload


@dataclass(frozen=True)
class Scope:
    """What a collection admits; empty lists admit everything."""

    first: dt.date
    last: dt.date
    domains: tuple[str, ...] = ()
    fields: tuple[str, ...] = ()
    not_domains: tuple[str, ...] = ()
    not_fields: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.first > self.last:
            raise ValueError("scope ends before it begins")

    def allowed(self, identifier: Column, admitted: tuple[str, ...]) -> Column:
        """With a list, a missing or foreign identifier is out."""
        return F.coalesce(identifier.isin(*admitted), F.lit(False)) if admitted else F.lit(True)

    def denied(self, identifier: Column, refused: tuple[str, ...]) -> Column:
        """A missing identifier is kept."""
        return F.coalesce(identifier.isin(*refused), F.lit(False)) if refused else F.lit(False)

    def disposition(self, published: Column, expansion: Column, identity: Column, domain: Column, field_: Column) -> Column:
        """The first reason that applies, or ``selected``; published is text."""
        day = dates.iso_date(published)
        classified = self.allowed(domain, self.domains) & self.allowed(field_, self.fields) & ~self.denied(domain, self.not_domains) & ~self.denied(field_, self.not_fields)
        return (
            F.when(day.isNull(), "quarantine:publication_date")
            .when(expansion.isNull(), "quarantine:corpus_flag")
            .when(expansion, "excluded:expansion")
            .when(~day.between(F.lit(self.first), F.lit(self.last)), "excluded:date")
            .when(F.coalesce(identity, F.lit("")) == "", "quarantine:identity")
            .when(~classified, "excluded:classification")
            .otherwise("selected")
        )

    def source_filter(self) -> dict[str, str]:
        """The same policy as a source's filter text; what comes back is judged again by :meth:`disposition`."""
        parts = [f"from_publication_date:{self.first.isoformat()}", f"to_publication_date:{self.last.isoformat()}"]
        parts += [f"primary_topic.{k}.id:{'|'.join(v)}" for k, v in (("domain", self.domains), ("field", self.fields)) if v]
        parts += [f"primary_topic.{k}.id:!{x}" for k, v in (("domain", self.not_domains), ("field", self.not_fields)) for x in v]
        return {"corpus": "core", "filter": ",".join(parts)}


def disposition_counts(rows: DataFrame) -> DataFrame:
    """kind, n: dispositions counted by the part before the colon."""
    return rows.groupBy(F.split("disposition", ":")[0].alias("kind")).agg(F.count("*").alias("n"))


@dataclass(frozen=True)
class CorpusRules:
    first: dt.date
    last: dt.date
    types: tuple[str, ...] = ("article",)
    refused_domains: tuple[str, ...] = field(default=())


def exclusion(rules: CorpusRules, kind: Column, published: Column, domain: Column) -> Column:
    """Cheap reasons in declared order, before any abstract is read: work_type, publication_date, excluded_domain, else null.

    published is compared as text, as ISO dates order alike; an unknown domain stays.
    """
    typed = F.coalesce(kind.isin(*rules.types), F.lit(False))
    dated = F.coalesce(published.between(F.lit(rules.first.isoformat()), F.lit(rules.last.isoformat())), F.lit(False))
    refused = F.coalesce(domain.isin(*rules.refused_domains), F.lit(False)) if rules.refused_domains else F.lit(False)
    return F.when(~typed, "work_type").when(~dated, "publication_date").when(refused, "excluded_domain")


def judged(current: DataFrame, versions: DataFrame, rules: CorpusRules) -> DataFrame:
    """Every considered entity with its reason (null: selected); conflicting entities are reported, not resolved.

    current: entity_id, version_id. versions: version_id, kind, published, domain, title, inverted.
    The abstract is only parsed for rows that no cheaper rule has excluded.
    """
    one = current.groupBy("entity_id").agg(F.min("version_id").alias("version_id"), (F.min("version_id") != F.max("version_id")).alias("several"))
    rows = one.join(versions, "version_id", "left")
    cheap = F.when(F.col("several"), "version_conflict").otherwise(exclusion(rules, F.col("kind"), F.col("published"), F.col("domain")))
    rows = rows.withColumn("reason", cheap).withColumn("abstract", F.when(F.col("reason").isNull(), payload.abstract(F.col("inverted"))))
    return rows.withColumn("reason", F.when(F.col("reason").isNull() & F.col("abstract").isNull(), "missing_abstract").otherwise(F.col("reason"))).drop("inverted", "several")


def ledger(rows: DataFrame) -> DataFrame:
    """One row: considered, selected, a count per reason, and unknown_domain and missing_title among the selected."""
    kept = F.col("reason").isNull()
    reasons = ("version_conflict", "work_type", "publication_date", "excluded_domain", "missing_abstract")
    out = rows.agg(F.count("*").alias("considered"), F.count(F.when(kept, 1)).alias("selected"), *(F.count(F.when(F.col("reason") == r, 1)).alias(r) for r in reasons), F.count(F.when(kept & F.col("domain").isNull(), 1)).alias("unknown_domain"), F.count(F.when(kept & (F.coalesce("title", F.lit("")) == ""), 1)).alias("missing_title"))
    total = F.col("selected")
    for r in reasons:
        total = total + F.col(r)
    return out.withColumn("balanced", F.col("considered") == total)


def manifest(rows: DataFrame) -> DataFrame:
    """The selected works in byte order of entity and version."""
    return rows.where(F.col("reason").isNull()).select("entity_id", "version_id", "title", "abstract", "published", "domain").orderBy("entity_id", "version_id")
