"""PubMed articles in full: text with mark-up inside, dates of both kinds, headings, chemicals and supplementary concepts.

Files are split at the end of each article, so Spark deals out the records. A small parser turns a record into
fields as they stand; text and dates are then cleaned and chosen by columns.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from calendar import month_abbr, month_name

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lithos.functions import text as tx
from lithos.sources.files import earlier_date
from lithos.sources.readers import unescape

# Elements whose content is no text, elements that begin a new block, and publication types that say nothing.
IGNORED = {
    "table", "table-wrap", "xref", "disp-formula", "inline-formula", "ref-list", "bio", "ack", "graphic", "media", "tex-math", "mml:math", "object-id", "ext-link",
}
SEPARATE = {"title", "p", "sec", "break", "def-item", "list-item", "caption"}
SKIPPED_TYPES = (
    "Research Support, N.I.H., Intramural", "Research Support, Non-U.S. Gov't", "Research Support, U.S. Gov't, P.H.S.",
    "Research Support, N.I.H., Extramural", "Research Support, U.S. Gov't, Non-P.H.S.", "English Abstract",
)
DATE = "struct<year:int,month:int,day:int>"
HEADING = "struct<id:string,name:string,major:string>"
FIELDS = f"""pubmed_id string, pmcid string, doi string, title_blocks array<string>, abstract_blocks array<string>, language string, authors array<string>,
  mesh array<array<{HEADING}>>, chemicals array<struct<id:string,name:string>>, supplementary_concepts array<struct<id:string,type:string,name:string>>,
  journal string, journaliso string, journal_date {DATE}, entry_date {DATE}, medline_pubtype array<string>, reference_count int"""
NAMES = (
    "pubmed_id", "pmcid", "doi", "title_blocks", "abstract_blocks", "language", "authors", "mesh", "chemicals", "supplementary_concepts",
    "journal", "journaliso", "journal_date", "entry_date", "medline_pubtype", "reference_count",
)
MONTHS = {m.lower(): i for names in (month_name, month_abbr) for i, m in enumerate(names) if m}


def blocks(elements: list[ET.Element]) -> list[str]:
    """The text of elements: pieces joined by blanks, cut before each element that separates and after each of the list."""
    out: list[list[str]] = [[]]

    def walk(e: ET.Element) -> None:
        if e.tag not in IGNORED:
            if e.tag in SEPARATE:
                out.append([])
            out[-1].append(e.text or "")
            for child in e:
                walk(child)
        out[-1].append(e.tail or "")

    for e in elements:
        walk(e)
        out.append([])
    joined = [" ".join(s for s in map(str.strip, pieces) if s) for pieces in out]
    return [b.replace("\n", " ") for b in joined if b]


def _number(text: str | None) -> int | None:
    if not text:
        return None
    return MONTHS.get(text.strip().lower()) or (int(text) if text.strip().isdigit() else None)


def _date(year: int | None, month: int | None, day: int | None) -> dict:
    return {"year": year if year and 1700 < year < 2100 else None, "month": month, "day": day}


def journal_date(date: ET.Element | None) -> dict:
    """The issue's date; free text gives a year and the first month that it names, full names first."""
    if date is None:
        return _date(None, None, None)
    free = date.findtext("MedlineDate")
    if free is None:
        return _date(*(_number(date.findtext(part)) for part in ("Year", "Month", "Day")))
    year = re.search(r"(18|19|20)\d\d", free)
    month = next((m for m in [*month_name, *month_abbr] if m and m in free), None)
    return _date(int(year[0]) if year else None, _number(month), None)


def entry_date(history: list[ET.Element]) -> dict:
    """The date of entry: of those by status pubmed, entrez or medline, in this order, else the first."""
    dates = {}
    for h in history:
        date = _date(*(_number(h.findtext(part)) for part in ("Year", "Month", "Day")))
        if date["year"]:
            dates[h.get("PubStatus")] = date
    return next((dates[s] for s in ("pubmed", "entrez", "medline") if s in dates), next(iter(dates.values()), _date(None, None, None)))


def _author(a: ET.Element) -> str | None:
    fore, last = a.findtext("ForeName"), a.findtext("LastName")
    return " ".join(x for x in (fore, last) if x) or a.findtext("CollectiveName")


def record(xml: str) -> dict | None:
    """The fields of one article; null if there is none, its id is no number or it has no title."""
    at = xml.find("<PubmedArticle>") if "<PubmedArticle>" in xml else xml.find("<PubmedArticle ")
    if at < 0:
        return None
    root = ET.fromstring(xml[at:] if "</PubmedArticle>" in xml else xml[at:] + "</PubmedArticle>")
    article, pmid = root.find("MedlineCitation/Article"), root.findtext("MedlineCitation/PMID") or ""
    title = blocks(article.findall("ArticleTitle")) or blocks(article.findall("VernacularTitle"))
    if not pmid.isdigit() or not title:
        return None
    ids = {i.get("IdType"): i.text for i in root.findall("PubmedData/ArticleIdList/ArticleId")}
    head = lambda e: {"id": e.get("UI"), "name": e.text, "major": e.get("MajorTopicYN")}
    references = root.findall("PubmedData/ReferenceList/Reference")
    return {
        "pubmed_id": pmid, "pmcid": ids.get("pmc"), "doi": ids.get("doi"),
        "title_blocks": title, "abstract_blocks": blocks(article.findall("Abstract/AbstractText")), "language": article.findtext("Language"),
        "authors": [_author(a) for a in article.findall("AuthorList/Author")],
        "mesh": [[head(e) for e in (h.find("DescriptorName"), *h.findall("QualifierName"))] for h in root.findall("MedlineCitation/MeshHeadingList/MeshHeading")],
        "chemicals": [{"id": e.get("UI"), "name": e.text} for e in root.findall("MedlineCitation/ChemicalList/Chemical/NameOfSubstance")],
        "supplementary_concepts": [{"id": e.get("UI"), "type": e.get("Type"), "name": e.text} for e in root.findall("MedlineCitation/SupplMeshList/SupplMeshName")],
        "journal": " ".join(e.text or "" for e in article.findall("Journal/Title")), "journaliso": " ".join(e.text or "" for e in article.findall("Journal/ISOAbbreviation")),
        "journal_date": journal_date(article.find("Journal/JournalIssue/PubDate")), "entry_date": entry_date(root.findall("PubmedData/History/PubMedPubDate")),
        "medline_pubtype": [e.text for e in article.findall("PublicationTypeList/PublicationType")], "reference_count": len(references) or None,
    }


def _cleaned(x: Column) -> Column:
    return tx.applied(x, [*tx.CONTROL_RULES, *tx.COMMA_RULES])


def articles(records: DataFrame, column: str = "value") -> DataFrame:
    """Articles from a column of raw records; rows without a usable article go."""
    def parse(frames):
        for frame in frames:
            yield pd.DataFrame([r for r in map(record, frame[column].dropna()) if r], columns=list(NAMES))

    rows = records.select(column).mapInPandas(parse, FIELDS)
    # Entities inside entities: the parser resolves one layer, a Python helper the other.
    title = tx.applied(unescape(tx.unbracketed(_cleaned(F.get("title_blocks", F.lit(0))))), tx.BRACKET_RULES)
    lines = F.filter(F.transform("abstract_blocks", _cleaned), lambda x: x != "")
    abstract = tx.applied(unescape(F.array_join(lines, "\n")), tx.BRACKET_RULES)
    rows = rows.withColumns({"title": title, "abstract": abstract, "doi": F.when(F.col("doi").rlike(r"^[0-9.]+/.+[^/]$"), F.col("doi"))})
    date = earlier_date(F.col("journal_date"), F.col("entry_date"))
    parts = {f"publish_{c}": date[c] for c in ("year", "month", "day")}
    types = F.filter("medline_pubtype", lambda t: ~t.isin(*SKIPPED_TYPES))
    rows = rows.withColumns({**parts, "medline_pubtype": types, "url": F.concat(F.lit("https://www.ncbi.nlm.nih.gov/pubmed/"), "pubmed_id")})
    return rows.drop("title_blocks", "abstract_blocks", "journal_date", "entry_date")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Articles of PubMed XML files, compressed ones too."""
    records = spark.read.option("lineSep", "</PubmedArticle>").text(path)
    return articles(records.where(F.col("value").contains("<PubmedArticle")))
