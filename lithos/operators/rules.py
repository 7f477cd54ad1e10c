"""Rule categories, language flags, relevance and article types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
NON_RESEARCH = ("Review", "Book chapter", "Comment/Editorial", "Retracted", "CDC Weekly Report", "News")
ARTICLE_TYPES = (*NON_RESEARCH, "Research", "Meta-analysis")
WEEKLY_REPORT = "MMWR. Morbidity and Mortality Weekly Report"
TRIAL = r"(^|[^a-z0-9_])(ctr[0-9]{4,}|nct\s*[0-9]{4,})($|[^a-z0-9_])"
#: Frequent words of each language; a language is flagged by five of them.
STOPWORDS = {
    "french": ("les", "des", "une", "est", "que", "dans", "pour", "la", "le", "du", "au", "un", "leur", "ou", "par", "pas", "de", "en"),
    "german": ("der", "das", "und", "den", "dem", "ein", "eine", "ist", "nicht", "von", "mit", "auf", "zu", "sich", "im", "auß"),
    "spanish": ("los", "las", "una", "que", "por", "con", "para", "del", "como", "más", "el", "la", "de", "no", "su", "un", "lo"),
}


def is_trial(abstract: Column) -> Column:
    low = F.lower(abstract)
    return (low.contains("ctr") | low.contains("nct")) & low.rlike(TRIAL)  # few texts hold either, and the pattern is slow


def said_categories(title: Column, abstract: Column, journal: Column) -> Column:
    """Categories by the trial, weekly report and chapter rules."""
    more = lambda test, name: F.when(test, F.array(F.lit(name))).otherwise(F.array().cast("array<string>"))
    return F.concat(
        more(is_trial(abstract), "Clinical Trials"),
        more(journal == WEEKLY_REPORT, "CDC Weekly Report"),
        more(title.rlike(r"(?i)Chapter [0-9]"), "Book chapter"),
    )


def with_said(base: Column, said: Column) -> Column:
    """Sorted distinct categories: those of ``base`` and ``said``, and Research by default."""
    found = F.concat(F.coalesce(base, F.array().cast("array<string>")), said)
    found = F.when(F.array_contains(found, "Meta-analysis"), F.array_remove(found, "Review")).otherwise(found)
    other = F.arrays_overlap(found, F.array(*[F.lit(x) for x in NON_RESEARCH]))
    return F.array_sort(F.array_distinct(F.when(other, found).otherwise(F.array_append(found, F.lit("Research")))))


def rule_categories(base: Column, title: Column, abstract: Column, journal: Column) -> Column:
    """Sorted distinct categories: trial, weekly report and chapter rules, and Research by default."""
    return with_said(base, said_categories(title, abstract, journal))


def article_types(categories: Column) -> Column:
    return F.filter(categories, lambda c: c.isin(*ARTICLE_TYPES))


def topics(categories: Column) -> Column:
    return F.filter(categories, lambda c: ~c.isin(*ARTICLE_TYPES))


def language_flags(text: Column, least: int = 5) -> Column:
    """Languages of which ``least`` distinct stopwords stand between blanks, comma-joined; else english."""
    # The first and the last word have no blank on one side.
    inner = F.regexp_replace(F.regexp_replace(F.lower(text), r"^\S+", ""), r"\S+$", "")
    array = lambda ws: F.array(*[F.lit(w) for w in ws])
    # One pass finds the stopwords of all languages; the languages are then told apart on those few.
    few = F.array_intersect(F.split(inner, r"\s+"), array(sorted({w for ws in STOPWORDS.values() for w in ws})))
    flags = lambda x: F.array_join(F.array(*[F.when(F.size(F.array_intersect(x, array(ws))) >= least, F.lit(name)) for name, ws in STOPWORDS.items()]), ",")
    joined = F.get(F.transform(F.array(few), flags), 0)
    return F.regexp_replace(joined, "^$", "english")


def article_type(title: Column) -> Column:
    """The first that fits of an ordered list of kinds, by how a title begins."""
    low = F.lower(title)
    begins = lambda *xs: low.rlike("^(" + "|".join(xs) + ")")
    return (
        F.when(begins("retraction", "retracted", "withdrawn"), "Retracted")
        .when(begins("erratum", "correction"), "Erratum")
        .when(begins("news"), "News")
        .when(begins("editorial", "comment"), "Comment/Editorial")
        .when(begins("chapter "), "Book chapter")
        .when(low.contains("meta-analysis"), "Meta-analysis")
        .when(begins("review", "systematic review"), "Review")
        .when(begins("case report", "research"), "Research")
    )


def popular_or_recent(score: Column, known: Column, published: Column, as_of: Column, least: float = 10, days: int = 15) -> Column:
    """Attention above ``least``, nothing known yet, or published within ``days`` of ``as_of`` on either side."""
    return F.coalesce(score > least, F.lit(False)) | ~known | F.coalesce(F.abs(F.datediff(as_of, published)) <= days, F.lit(False))
