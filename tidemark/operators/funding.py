"""Funding events from English and Russian headlines, and the identity that reprints share.

Everything is one struct expression over the cleaned headline, which is bound once. Java patterns take
the prefix (?iuU): case-insensitive also for Cyrillic, and word classes by Unicode.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.binding import let
from tidemark.functions.text import normalize
from tidemark.sources.durable import spread, stored

EXTRACTOR = "headline-v2"
FLAG = "(?iuU)"

# Spacing repairs of tokenised headlines, in order (pattern, replacement).
SPACING = (
    (r"\s+-\s+", "-"),
    (r"\(\s+", "("),
    (r"\s+\)", ")"),
    (r"«\s+", "«"),
    (r"\s+»", "»"),
    (r"(\d)\s*\.\s*(\d)", "$1.$2"),
    (r"(\d)\s*,\s*(\d{3})\b", "$1$2"),
    (r"\s+([,.:;!?%])", "$1"),
    (r"([$€£¥₹₽])\s+", "$1"),
)
# Currency by the first of these that begins the matched sign, and factor by unit likewise.
CURRENCIES = {"us$": "USD", "$": "USD", "usd": "USD", "долл": "USD", "€": "EUR", "eur": "EUR", "евро": "EUR", "£": "GBP", "gbp": "GBP", "¥": "JPY", "₹": "INR", "₽": "RUB", "rub": "RUB", "руб": "RUB"}
UNITS = {"k": 1e3, "thousand": 1e3, "тыс": 1e3, "m": 1e6, "mn": 1e6, "mln": 1e6, "million": 1e6, "млн": 1e6, "миллион": 1e6, "b": 1e9, "bn": 1e9, "billion": 1e9, "млрд": 1e9, "миллиард": 1e9}
# Cyrillic series letters that stand for Latin ones.
SERIES = {"а": "a", "в": "b", "с": "c", "е": "e"}
# Headline patterns by language.
ENGLISH = {
    "market_report": r"\b(market|forecast|cagr|market size|industry analysis|outlook)\b|\bby 20\d\d\b",
    "m_and_a": r"\b(acquires|acquired by|to acquire|acquisition of|merges with|buys)\b",
    "ipo": r"\b(ipo|initial public offering|goes public|to go public)\b",
    "grant": r"\b(receives|wins|awarded|secures|lands)\b.*\bgrant\b",
    "round_verb": r"\b(raises|raised|secures|secured|closes|closed|lands|bags|nabs|completes|announces|gets|attracts)\b",
    "round_noun": r"\b(funding|round|pre-seed|seed|series [a-h]|investment|financing|capital)\b",
    "stages": ((r"\bpre-seed\b", "pre_seed"), (r"\bseries ([a-h])\b", None), (r"\bseed\b", "seed"), (r"\bgrowth (round|equity|funding)\b", "growth"), (r"\bbridge\b", "bridge")),
    # (pattern, group of the number, of the unit, of the currency)
    "amounts": ((r"(US\$|\$|€|£|¥|₹|₽|USD|EUR|GBP|RUB)\s?(\d+(?:\.\d+)?)\s?(thousand|million|billion|mln|mn|bn|k|m|b)?\b", 2, 3, 1),),
    "subject": r"^(.+?)\s+(raises|raised|secures|secured|closes|closed|lands|bags|nabs|completes|announces|gets|attracts|acquires|to acquire|buys|merges with|goes public|files|receives|wins|is awarded)\b",
    "investors": (r"\bled by ([^,;|()]+)", 1),
}
RUSSIAN = {
    "market_report": r"(объ[её]м рынка|рынок .{0,40}достигнет|прогноз|среднегодов)",
    "m_and_a": r"\b(приобр[её]л[аи]?|купил[аи]?|поглотил[аи]?|покупк[аеиу]|приобретени[еяю]|слияни[еяю])\b",
    "ipo": r"(\bipo\b|\bspo\b|выход\w* на биржу|разместил[аи]? акции|размещени[еяю] акций)",
    "grant": r"(получил[аи]?|выиграл[аи]?|выделил[аи]?|присудил[аи]?).*грант",
    "round_verb": r"\b(привл[её]к(л[аи])?|получил[аи]?|закрыл[аи]?|инвестировал[аи]?|вложил[аи]?|проинвестировал[аи]?)\b",
    "round_noun": r"(инвестици\w*|раунд\w*|финансировани\w*|посевн\w*|сери[июя] [a-hа-в]\b|венчурн\w*)",
    "stages": ((r"(pre-seed|пре-?сид|предпосевн)", "pre_seed"), (r"сери[июя] ([a-hа-в])\b", None), (r"(посевн|\bseed\b)", "seed")),
    "amounts": (
        (r"(\d+(?:[.,]\d+)?)\s?(тыс|млн|миллион\w*|млрд|миллиард\w*)\.?\s?(руб|₽|долл|\$|евро|€)", 1, 2, 3),
        (r"(\$|€|₽)\s?(\d+(?:[.,]\d+)?)\s?(тыс|млн|млрд)?", 2, 3, 1),
    ),
    "subject": r"^(.+?)\s+(привл[её]к(л[аи])?|получил[аи]?|закрыл[аи]?|приобр[её]л[аи]?|купил[аи]?|поглотил[аи]?|выш(ел|ла|ли) на|разместил[аи]?|выиграл[аи]?)\b",
    "investors": (r"(при участии|во главе с|под руководством|от фонда) ([^,;|()]+)", 2),
}


def clean(title: Column) -> Column:
    """Tokenised spacing undone, and what follows the first `` | `` dropped."""
    text = F.trim(F.regexp_replace(title, r"\s+", " "))
    for pattern, replacement in SPACING:
        text = F.regexp_replace(text, pattern, replacement)
    return F.trim(F.substring_index(text, " | ", 1))


def _has(text: Column, pattern: str) -> Column:
    return text.rlike(FLAG + pattern)


def _group(text: Column, pattern: str, group: int) -> Column:
    """A group of the first match; null where there is no match or the group is empty."""
    return F.nullif(F.regexp_extract(text, FLAG + pattern, group), F.lit(""))


def _by_prefix(token: Column, table: dict) -> Column:
    """The value of the first key, in the table's order, with which the token begins; the token is made once."""

    def first(low: Column) -> Column:
        out = F.when(F.lit(False), F.lit(None))
        for key, value in table.items():
            out = out.when(F.startswith(low, F.lit(key)), F.lit(value))
        return out

    return let(F.lower(token), first)


def _amount(text: Column, rules: dict) -> Column:
    """struct(amount, currency) of the first pattern that matches."""
    options = []
    for pattern, number, unit, currency in rules["amounts"]:
        value = F.replace(_group(text, pattern, number), F.lit(","), F.lit(".")).try_cast("double")
        factor = F.coalesce(_by_prefix(_group(text, pattern, unit), UNITS).cast("double"), F.lit(1.0))
        options.append(F.when(_has(text, pattern), F.struct((value * factor).alias("amount"), _by_prefix(_group(text, pattern, currency), CURRENCIES).cast("string").alias("currency"))))
    return F.coalesce(*options)


def _company(text: Column, rules: dict) -> Column:
    subject = F.substring_index(F.regexp_extract(text, FLAG + rules["subject"], 1), ":", -1)
    own = F.regexp_replace(subject, "^[ '\"]+|[ '\"]+$", "")
    named = let(own, lambda name: F.when((name != "") & (F.size(F.split(name, r"\s+")) <= 6), name))
    return let(F.regexp_extract(text, "«([^»]{2,60})»", 1), lambda quoted: F.when(quoted != "", F.trim(quoted)).otherwise(named))


def _stage(text: Column, rules: dict) -> Column:
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for pattern, label in rules["stages"]:
        if label is None:
            letter = F.lower(F.regexp_extract(text, FLAG + pattern, 1))
            latin = F.translate(letter, "".join(SERIES), "".join(SERIES.values()))
            out = out.when(_has(text, pattern), F.concat(F.lit("series_"), latin))
        else:
            out = out.when(_has(text, pattern), F.lit(label))
    return out


def _event(text: Column, rules: dict) -> Column:
    return let(_amount(text, rules), lambda money: _named(text, rules, money))


def _named(text: Column, rules: dict, money: Column) -> Column:
    round_ = _has(text, rules["round_verb"]) & (_has(text, rules["round_noun"]) | money["amount"].isNotNull())
    kind = F.when(_has(text, rules["market_report"]), F.lit(None)).when(_has(text, rules["m_and_a"]), "m_and_a").when(_has(text, rules["ipo"]), "ipo").when(_has(text, rules["grant"]), "grant").when(round_, "vc_round")
    investors = F.trim(_group(text, *rules["investors"]))
    event = lambda k: F.when(k.isNotNull(), F.struct(k.alias("event_type"), _company(text, rules).alias("company"), F.when(k == "vc_round", _stage(text, rules)).alias("stage"), money["amount"].alias("amount"), money["currency"].alias("currency"), investors.alias("investors")))
    return let(kind, event)


def extract(title: Column) -> Column:
    """struct(event_type, company, stage, amount, currency, investors), or null for no event and market reports."""
    return let(clean(title), lambda text: F.when(_has(text, "[а-яё]"), _event(text, RUSSIAN)).otherwise(_event(text, ENGLISH)))


def _python_float(value: Column) -> Column:
    """A rounded amount as reprint keys write it: a plain decimal with one zero after the point."""
    return F.coalesce(F.concat(value.cast("decimal(38,0)").cast("string"), F.lit(".0")), F.lit("None"))


def event_id(event: Column, month: Column, fallback: Column) -> Column:
    """Reprints share type, company, stage, amount to the nearest 100,000 (half to even), currency and month."""
    none = F.lit("None")
    parts = [event["event_type"], normalize(event["company"]), F.coalesce(event["stage"], none), _python_float(F.bround(event["amount"] / 100000, 0) * 100000), F.coalesce(event["currency"], none), F.date_format(month, "yyyy-MM-dd")]
    key = F.when(event["company"].isNull(), F.concat(F.lit("article|"), fallback)).otherwise(reduce(lambda a, b: F.concat(a, F.lit("|"), b), parts))
    return F.sha2(F.concat(F.lit(f"{EXTRACTOR}\n"), key), 256)


def events(articles) -> tuple:
    """(events, event_articles): one event per identity, the first seen article deciding its fields.

    articles: article_id, title, seen_at. Titles are read once, by tasks to which the articles are dealt evenly.
    """
    month = F.trunc(F.col("seen_at").cast("date"), "MM")
    named = let(extract(F.col("title")), lambda e: F.when(e.isNotNull(), F.struct(e.alias("event"), event_id(e, month, F.col("article_id").cast("string")).alias("event_id"))))
    rows = spread(articles.select("article_id", "title", "seen_at")).select("article_id", "seen_at", month.alias("month"), F.explode(F.array_compact(F.array(named))).alias("n")).select("article_id", "seen_at", "month", "n.event", "n.event_id")
    rows = stored(rows, "events", wide=True)
    first = rows.groupBy("event_id").agg(F.min_by(F.struct("event.*", "month"), F.struct("seen_at", "article_id")).alias("e"))
    return first.select("event_id", "e.*"), rows.select("event_id", "article_id").distinct()
