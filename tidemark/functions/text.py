"""Text expressions: normalisation, phrase matching, identities, markup."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: White space of headline and term texts: one space for each run, none at the ends.
RUN = r"\s+"


def squeeze(text: Column) -> Column:
    """Runs of white space become one space; trimmed."""
    return F.trim(F.regexp_replace(text, RUN, " "))


def normalize(text: Column) -> Column:
    """Lower case, runs of other than letters, digits and underscores to one space, underscores to spaces; null is empty.

    Underscores are replaced last, so ``a__b`` keeps two spaces.
    """
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.trim(F.translate(F.regexp_replace(low, r"[^\p{L}\p{N}_]+", " "), "_", " "))


def contains_phrase(text: Column, normalized_term: Column) -> Column:
    """Whole-phrase match of a normalised term in a text, on word boundaries."""
    return F.contains(F.concat(F.lit(" "), normalize(text), F.lit(" ")), F.concat(F.lit(" "), normalized_term, F.lit(" ")))


def term_id(normalized: Column) -> Column:
    return F.sha2(F.concat(F.lit("term-v1\n"), normalized), 256)


def digest(value: Column) -> Column:
    """SHA-256 that keeps null."""
    return F.sha2(value, 256)


def strip_nul(text: Column) -> Column:
    return F.replace(text, F.lit("\0"), F.lit(""))


def content_hash(title: Column, text: Column, limit: int) -> Column:
    return F.sha2(F.concat(F.coalesce(title, F.lit("")), F.lit("\n"), F.substring(text, 1, limit)), 256)


def phrase_text(phrase: Column) -> Column:
    """A term as searched: quotes out, white space squeezed."""
    return squeeze(F.translate(phrase, '"', " "))


def embedding_text(title: Column, abstract: Column) -> Column:
    return F.when(F.coalesce(title, F.lit("")) == "", abstract).otherwise(F.concat(title, F.lit("\n"), abstract))


def clip(text: Column, limit: int = 2000) -> Column:
    """Squeezed text of at most limit characters, the cut marked by an ellipsis."""
    flat = squeeze(text)
    return F.when(F.length(flat) > limit, F.concat(F.rtrim(F.substring(flat, 1, limit)), F.lit("…"))).otherwise(flat)


#: Named references that occur in plain markup; the ampersand goes last so nothing is decoded twice.
ENTITIES = (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def plain(markup: Column) -> Column:
    """Markup without tags, common character references decoded, white space squeezed (JVM only).

    :func:`plain_udf` decodes every reference of HTML.
    """
    out = F.regexp_replace(F.coalesce(markup, F.lit("")), "<[^>]+>", " ")
    for name, sign in ENTITIES:
        out = F.replace(out, F.lit(name), F.lit(sign))
    return squeeze(out)


def plain_udf(markup: Column) -> Column:
    """Like :func:`plain`, with all character references of HTML, by an Arrow batch UDF."""
    @F.pandas_udf(StringType())
    def unescape(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: " ".join(html.unescape(t).split()))

    return unescape(F.regexp_replace(F.coalesce(markup, F.lit("")), "<[^>]+>", " "))


def without_secrets(url: Column, names: tuple[str, ...] = ("key", "token", "access_token", "api_key", "secret")) -> Column:
    """A locator without its credential parameters."""
    out = F.regexp_replace(url, rf"(?i)([?&])(?:{'|'.join(names)})=[^&#]*", "$1")
    return F.regexp_replace(F.regexp_replace(out, r"([?&])&+", "$1"), r"[?&]+(#|$)", "$1")
