"""Rules whose cases the tables do not hold, over small made-up records; the SQL lists the rows that must come out."""

from __future__ import annotations

from pyspark.sql import functions as F

from lithos.functions import dates
from lithos.functions import text as tx
from lithos.operators import dedupe, mentions, release, star, variants, web
from lithos.sources import files, pubmed, readers
from lithos.streaming import incremental

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def expected(columns: str, *rows: str):
    """Registers a query whose result is the listed rows."""

    def add(f):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = f"SELECT {columns} FROM (VALUES {', '.join(rows)}) t({', '.join(c.split(' AS ')[-1] for c in columns.split(', '))})"
        return f

    return add


LONG = "A title of well over twenty characters"
ABSTRACT = "An abstract that is certainly longer than fifty characters, as the rule wants"
RECORD = "ord long, cord_uid string, pubmed_id string, doi string, pmcid string, url string, title string, abstract string, authors string, journal string, publish_year int, publish_month int, publish_day int, extra boolean"


def records(spark):
    rows = [
        # 1, 2 and 3 are one through 2: a DOI, then a PubMed id; the PubMed record has a date, so CORD's goes.
        (1, "c1", "", "10.1/a", "", "", "Short", "x", "", "medRxiv", 2019, 1, 1, True),
        (2, "c2", "7", "10.1/a", "", "http://z; https://www.ncbi.nlm.nih.gov/pubmed/7/", "A longer title", "abc", "", "Nature", 2021, 5, 9, None),
        (3, "", "7", "", "PMC3", "http://www.ncbi.nlm.nih.gov/pubmed/7", "Long", "abcdef", "", "Nature", 2020, 6, None, False),
        # 4 and 5 share year, title and journal in other case and punctuation; 6 has another year.
        (4, "c4", "", "", "", "http://four;http://4", LONG, "", "", "The Lancet.", 2020, None, None, None),
        (5, "c5", "", "", "", "", LONG.upper() + "!", "y", "", "the lancet", 2020, 3, None, None),
        (6, "c6", "", "", "", "", LONG, "", "", "the lancet", 2021, None, None, None),
        # A title of 19 characters links nothing; one of 20 does, by the abstract.
        (7, "c7", "", "", "", "", "x" * 19, ABSTRACT, "A; B", "J", 2018, None, None, None),
        (8, "c8", "", "", "", "", "x" * 19, ABSTRACT, "A; B", "J", 2018, None, None, None),
        (9, "c9", "", "", "", "", "y" * 20, ABSTRACT, "", "", 2018, None, None, None),
        (10, "c10", "", "", "", "", "y" * 20, ABSTRACT.upper(), "", "K", 2018, 2, 3, None),
        # The same authors as a list and as a string are compared as written.
        (11, "c11", "", "", "", "", "z" * 20, "", "A; B", "", 2017, None, None, None),
        (12, "c12", "", "", "", "", "z" * 20, "", '["A","B"]', "", 2017, None, None, None),
        (13, "c13", "", "", "", "", "z" * 20, "", "A; B", "L", 2017, None, None, None),
    ]
    return spark.createDataFrame(rows, RECORD)


@expected("CAST(ord AS BIGINT) AS ord, CAST(group_id AS BIGINT) AS group_id", *[f"({a}, {b})" for a, b in [(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (6, 6), (7, 7), (8, 8), (9, 9), (10, 9), (11, 11), (12, 12), (13, 11)]])
def merge_groups(spark, d):
    """Records that share one of the seven keys."""
    rows = records(spark)
    return dedupe.duplicate_groups(rows, "ord", dedupe.merge_keys(rows)).select("ord", "group_id")


@expected(
    "CAST(group_id AS BIGINT) AS group_id, title, journal, CAST(y AS INTEGER) AS y, CAST(m AS INTEGER) AS m, CAST(d AS INTEGER) AS d, url, CAST(is_preprint AS BOOLEAN) AS is_preprint, CAST(extra AS BOOLEAN) AS extra, cord_uids, pubmed_urls",
    "(1, 'A longer title', 'Nature', 2020, 6, NULL, 'https://doi.org/10.1/a', false, false, 'c1,c2', 'http://www.ncbi.nlm.nih.gov/pubmed/7,https://www.ncbi.nlm.nih.gov/pubmed/7')",
    f"(4, '{LONG.upper()}!', 'the lancet', 2020, 3, NULL, 'http://four', false, NULL, 'c4,c5', '')",
    f"(6, '{LONG}', 'the lancet', 2021, NULL, NULL, NULL, false, NULL, NULL, NULL)",
    f"(7, '{'x' * 19}', 'J', 2018, NULL, NULL, NULL, false, NULL, NULL, NULL)",
    f"(8, '{'x' * 19}', 'J', 2018, NULL, NULL, NULL, false, NULL, NULL, NULL)",
    f"(9, '{'y' * 20}', 'K', 2018, 2, 3, NULL, false, NULL, 'c10,c9', '')",
    f"(11, '{'z' * 20}', 'L', 2017, NULL, NULL, NULL, false, NULL, 'c11,c13', '')",
    f"(12, '{'z' * 20}', '', 2017, NULL, NULL, NULL, false, NULL, NULL, NULL)",
)
def merged_documents(spark, d):
    """One document a group: order of records, last non-empty values, dates, ids, URL and preprint flag."""
    out = dedupe.merged_documents(records(spark))
    ids = F.col("ids_from_merged_documents")
    return out.select(
        "group_id", "title", "journal", F.col("publish_year").alias("y"), F.col("publish_month").alias("m"), F.col("publish_day").alias("d"), "url", "is_preprint", "extra",
        F.array_join(ids["cord_uid"], ",").alias("cord_uids"), F.array_join(ids["url"], ",").alias("pubmed_urls"),
    )


@expected("CAST(ord AS BIGINT) AS ord, fault", "(2, 'no id')", "(3, 'doi format')", "(4, 'date')", "(5, 'future date')", "(6, 'date')")
def document_faults(spark, d):
    """Documents that break a rule of the merged table."""
    rows = [
        (1, "10.1/ab", "", "", "", 2020, 2, 29), (2, "", "", "", "", 2020, None, None), (3, "doi:10.1/a", "", "", "", 2020, 1, None), (4, "", "1", "", "", 2019, 2, 29),
        (5, "", "", "c", "", 2020, 6, 2), (6, "", "", "", "u", None, 3, None), (7, "", "", "", "u", None, None, None),
    ]
    df = spark.createDataFrame(rows, "ord long, doi string, pubmed_id string, cord_uid string, url string, publish_year int, publish_month int, publish_day int")
    return dedupe.document_faults(df, F.to_date(F.lit("2020-06-01")))


@expected("CAST(ord AS BIGINT) AS ord, released, queued", "(1, 'https://doi.org/10.1/a', 'pm5')", "(2, 'https://www.ncbi.nlm.nih.gov/pmc/articles/PMC2', 'x')", "(3, 'https://pubmed.ncbi.nlm.nih.gov/5', 'pm5')", "(4, 'http://first', 'http://first')", "(5, NULL, NULL)")
def url_priorities(spark, d):
    """The URL by priority of ids, for a release and for the annotation queue."""
    rows = [(1, "10.1/a", "PMC1", "5", "http://u"), (2, "", "PMC2", "", "x;y"), (3, None, " ", "5", ""), (4, "", "", "", "http://first;http://second"), (5, "", None, "", "")]
    df = spark.createDataFrame(rows, "ord long, doi string, pmcid string, pubmed_id string, url string")
    c = F.col
    queued = tx.first_url(F.when(c("pubmed_id") != "", F.concat(F.lit("pm"), "pubmed_id")), F.when(c("doi") != "", F.concat(F.lit("doi"), "doi")), c("url"))
    return df.select("ord", tx.canonical_url(c("doi"), c("pmcid"), c("pubmed_id"), c("url")).alias("released"), queued.alias("queued"))


def pages(spark):
    meta = [
        (1, "", "Journal One", {"citation_abstract": ["<b>" + "w" * 120 + "</b>"], "abstract": ["//" + "c" * 300, "v" * 119]}),
        (2, "own", "journal one", {"citation_abstract": ["w" * 200]}),
        (3, "", "Journal One", {"description": ["d" * 300], "journal_title": ["J. One"]}),
        (4, "", "journal one", {"abstract": ["漢" * 150, "s" * 100], "citation_journal_title": ["漢字", "J. One"]}),
        (5, "", "Journal One", {"DC.abstract": ["b" * 130, "a" * 130], "journal": ["Other name"]}),
        (6, "", "bioRxiv", {"journal": ["A server"]}),
        (7, "", "JJJ", {"journal": ["Short"]}),
        (8, "", "Alone", None),
    ]
    return spark.createDataFrame(meta, "ord long, abstract string, journal string, meta map<string,array<string>>")


@expected("CAST(ord AS BIGINT) AS ord, abstract", f"(1, '{'w' * 120}')", "(2, 'own')", "(3, '')", "(4, '')", f"(5, '{'a' * 130}')", "(6, '')", "(7, '')", "(8, '')")
def web_abstracts(spark, d):
    """Missing abstracts from the tags of scraped pages."""
    return pages(spark).select("ord", web.backfilled_abstract(F.col("abstract"), F.col("meta")).alias("abstract"))


@expected("CAST(ord AS BIGINT) AS ord, journal", "(1, 'J. One')", "(2, 'J. One')", "(3, 'J. One')", "(4, 'J. One')", "(5, 'Other name')", "(6, 'bioRxiv')", "(7, 'JJJ')", "(8, 'Alone')")
def web_journals(spark, d):
    """Journal names from scraped pages, and the most frequent one where a page has none."""
    return web.web_journal(pages(spark)).select("ord", "journal")


@expected(
    "CAST(ord AS BIGINT) AS ord, kind",
    "(1, 'Retracted')", "(2, 'Erratum')", "(3, 'News')", "(4, 'Comment/Editorial')", "(5, 'Comment/Editorial')", "(6, CAST(NULL AS VARCHAR))", "(7, 'Book chapter')", "(8, NULL)",
    "(9, 'Meta-analysis')", "(10, 'Review')", "(11, 'Research')", "(12, 'Research')", "(13, NULL)", "(14, 'Research')", "(15, 'Retracted')",
)
def web_kinds(spark, d):
    """Article types by page tags, publication types, titles and one journal's own words."""
    rows = [
        (1, "RETRACTED: x", "J", {"dc.type": ["News"]}, None), (2, "Correction to x", "J", {"category": ["Review"]}, []), (3, "x", "J", {}, ["Newspaper Article"]),
        (4, "x", "J", {"WT.cg_s": [" World View "]}, None), (5, "x", "Science", {"prism.section": ["Letter"]}, None), (6, "x", "Nature", {"prism.section": ["Letter"]}, None),
        (7, "Chapter 3 of x", "J", None, None), (8, "chapter 3 of x", "J", None, None), (9, "x", "J", None, ["Systematic Review", "Clinical Trial, Phase I"]),
        (10, "x", "J", {"citation_keywords": ["virus", "short review"]}, None), (11, "x", "J", {"articleType": ["Case-Report"]}, None), (12, "x", "J", None, ["Randomized Clinical Trial"]),
        (13, "x", "J", {"dc.Type": ["research" + " " * 50]}, None), (14, "x", "J", {"DC.Subject": ["Research Letter"]}, None), (15, "x", "J", {"dc.Type": ["Erratum"], "category": ["Retraction"]}, None),
    ]
    df = spark.createDataFrame(rows, "ord long, title string, journal string, meta map<string,array<string>>, pubtypes array<string>")
    return df.select("ord", web.inferred_article_type(F.col("title"), F.col("meta"), F.col("pubtypes"), F.col("journal")).alias("kind"))


@expected("CAST(ord AS BIGINT) AS ord, journal", "(1, 'medRxiv')", "(2, 'bioRxiv')", "(3, 'ChemRxiv')", "(4, 'arXiv')", "(5, 'Nature')")
def journal_names(spark, d):
    """Names of preprint servers in one spelling."""
    rows = [(1, "MedRxiv : the preprint server for health sciences"), (2, "biorxiv.org"), (3, "CHEMRXIV"), (4, "arXiv.org e-Print archive"), (5, "Nature")]
    return spark.createDataFrame(rows, "ord long, journal string").select("ord", tx.canonical_journal(F.col("journal")).alias("journal"))


@expected("CAST(doc_id AS BIGINT) AS doc_id, CAST(pos AS BIGINT) AS pos, CAST(n AS BIGINT) AS n, id", "(1, 0, 2, 'd1')", "(1, 0, 2, 'd2')", "(1, 7, 4, 'x4')", "(2, 1, 1, 'd3')")
def masked_mentions(spark, d):
    """Longest matches of any length; a conflicting term masks what it covers, and joined ids come apart."""
    terms = [("spike protein", "Gene", "d1;d2"), ("spike", "Gene", "d3"), ("spike protein of nothing", "conflicting", "c"), ("a b c d", "Other", "x4"), ("b c", "Other", "x2")]
    lookup = spark.createDataFrame(terms, "alias string, type string, id string")
    rows = [(1, "spike protein and spike protein of nothing a b c d"), (2, "the spike"), (3, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", F.split("text", " ").alias("w"))
    hits = mentions.mentions(docs, "w", lookup, only_longest=True)
    out = mentions.split_ids(mentions.without_type(hits))
    return out.select("doc_id", F.col("pos").cast("long").alias("pos"), F.col("n").cast("long").alias("n"), "id")


@expected("CAST(ord AS BIGINT) AS ord, viruses", "(1, 'SARS-CoV-2')", "(2, 'SARS-CoV')", "(3, '')", "(4, 'MERS-CoV,SARS-CoV')", "(5, 'SARS-CoV-2')", "(6, 'SARS-CoV-2')")
def plausible_viruses(spark, d):
    """Viruses that a document of its year can mean."""
    rows = [(1, ["SARS-CoV", "SARS-CoV-2"], 2020), (2, ["SARS-CoV", "SARS-CoV-2"], 2005), (3, ["MERS-CoV"], 1999), (4, ["MERS-CoV", "SARS-CoV"], 2013), (5, ["SARS-CoV-2", "MERS-CoV"], None), (6, ["SARS-CoV-2"], 0)]
    df = spark.createDataFrame(rows, "ord long, viruses array<string>, year int")
    return df.select("ord", F.array_join(F.array_sort(release.plausible_viruses(F.col("viruses"), F.col("year"))), ",").alias("viruses"))


@expected("CAST(doc_id AS BIGINT) AS doc_id, CAST(start AS BIGINT) AS start, id", "(1, 0, 's1')", "(1, 9, 'g')", "(1, 9, 's1')", "(2, 9, 'g')", "(2, 9, 's1')")
def virus_dependent(spark, d):
    """Proteins of several viruses: those of a document's only virus; a place with another kind of candidate keeps all."""
    c = [(0, "s1", "SARS-CoV"), (0, "s2", "SARS-CoV-2"), (9, "s1", "SARS-CoV"), (9, "g", None)]
    rows = [(i, a, a + 5, x, v, vs) for i, vs in ((1, ["SARS-CoV"]), (2, ["SARS-CoV", "SARS-CoV-2"])) for a, x, v in c]
    df = spark.createDataFrame(rows, "doc_id long, start long, end long, id string, associated_virus string, viruses array<string>")
    return release.resolve_by_virus(df, "viruses").select("doc_id", "start", "id")


@expected("CAST(doc_id AS BIGINT) AS doc_id, text", "(1, 'Reading')", "(3, 'reading')")
def exact_case_places(spark, d):
    """Locations only in the case of one of their aliases; other types in any."""
    hits = spark.createDataFrame([(1, "Location", "q1", "Reading"), (2, "Location", "q1", "reading"), (3, "Drug", "q2", "reading")], "doc_id long, type string, id string, text string")
    aliases = spark.createDataFrame([("q1", "Reading"), ("q1", "Reading, UK"), ("q2", "Reading")], "id string, alias string")
    return release.exact_case(hits, aliases).select("doc_id", "text")


@expected("alias, id", "('Paris', 'p')", "('PARIS', 'p')", "('City of Light', 'p')")
def place_terms(spark, d):
    """Places of the classes below one, with coordinates, in their own case."""
    edges = spark.createDataFrame([("city", "place"), ("capital", "city")], "child string, parent string")
    rows = [("p", "capital", "Paris", ["PARIS", "City of Light", "Par"], 2.3, 48.8), ("q", "river", "Seine", [], 1.0, 49.0), ("r", "city", "Nowhere", [], None, None)]
    terms = spark.createDataFrame(rows, "id string, class string, name string, aliases array<string>, longitude double, latitude double")
    return mentions.place_lookup(terms, web.transitive(edges, "place")).select("alias", "id")


@expected("CAST(load_order AS INTEGER) AS load_order, type, id, name, aliases", "(0, 'Drug', 'q1', 'aspirin', 'Aspirin,asa,aspirin')", "(0, 'Drug', 'q2', 'mine', 'own')", "(1, 'Topic', 'q2', 'mine', 'own')", "(1, 'Virus', 'q1', 'aspirin', 'Aspirin,asa,aspirin')")
def dictionary_files(spark, d):
    """Curated terms with labels and predefined ones, loaded in the manifest's order with its types."""
    curated = spark.createDataFrame([("Virus", "q1", "aspirin|asa"), ("Virus", "q2", "old|older")], "type string, id string, aliases string")
    labels = spark.createDataFrame([("q1", "Aspirin"), ("q9", "none")], "id string, label string")
    predefined = spark.createDataFrame([("q2", "Topic", "mine", ["own"])], "id string, type string, name string, aliases array<string>")
    terms = mentions.curated_terms(curated, labels, predefined)
    out = mentions.from_manifest([("Drug", terms), ("custom", terms)])
    return out.withColumn("aliases", F.array_join("aliases", ","))


@expected("CAST(ord AS BIGINT) AS ord, journal, abstract, tool, CAST(y AS INTEGER) AS y, CAST(m AS INTEGER) AS m, labels", "(1, 'medRxiv', 'Text.', 'medrxiv', 2020, 3, 'Molecular Biology,Therapeutics')", "(2, 'bioRxiv', 'Abstracted', 'ISO', 2019, NULL, '')", "(3, 'J', '', 'J', NULL, NULL, 'Other')")
def annotation_fields(spark, d):
    """Journal by source, abstract, journal and date for the annotation tool, and labels in groups."""
    rows = [
        (1, "Nature", "medrxiv", None, " ABSTRACT:. Text. ", "2020-03-01", ["Viral Biology", "Drug Repurposing", "Host Biology", "Review"]),
        (2, "x", "BioRxiv", "ISO", "abstractAbstracted", "2019", ["None"]), (3, "J", None, None, "abstract", "", ["Other", "Other"]),
    ]
    df = spark.createDataFrame(rows, "ord long, journal string, source string, iso string, abstract string, time string, labels array<string>")
    # Groups of labels, and labels that are no topics.
    groups = {"Host Biology": "Molecular Biology", "Viral Biology": "Molecular Biology", "Drug Targets": "Molecular Biology", "Drug Repurposing": "Therapeutics", "Novel Therapeutics": "Therapeutics"}
    c, date = F.col, dates.parse_partial(F.col("time"), strict=True)
    return df.select(
        "ord", tx.canonical_journal(c("journal"), c("source")).alias("journal"), tx.annotation_abstract(c("abstract")).alias("abstract"), tx.annotation_journal(c("journal"), c("iso"), c("source")).alias("tool"),
        date["year"].alias("y"), date["month"].alias("m"), F.array_join(tx.regrouped(c("labels"), groups, ["Review", "None"]), ",").alias("labels"),
    )


@expected(
    'CAST(row_id AS BIGINT) AS row_id, type, normalized, CAST(first AS INTEGER) AS first, CAST(past AS INTEGER) AS past',
    "(0, 'variant', 'p.T790E', 0, 5)", "(0, 'variant', 'p.T790M', 5, 7)", "(1, 'variant', 'c.93G>A', 0, 34)", "(2, 'variant', 'rs123', 18, 23)", "(3, 'variant', 'p.T790M', 0, 47)",
    "(4, 'lineage', 'B.1.1.7 (UK)', 0, 11)", "(4, 'lineage', 'B.1.1.7 (UK)', 16, 29)", "(5, 'variant', 'c.93_94del', 0, 10)", "(5, 'variant', 'p.T790fsX791', 15, 27)", "(6, 'lineage', 'P.1 (Brazil)', 2, 5)",
    "(9, 'variant', 'p.D614G', 8, 13)",
)
def variants_fixture(spark, d):
    """Variants and lineages of fixed strings; the test tables hold none."""
    texts = [
        "T790E/M", "G to A substitution at position 93", "THR790MET791 then rs123", "Threonine-to-Methionine mutation at residue 790", "20I/501Y.V1 and VOC 202012/01",
        "c.93_94del and p.T790fsX791", "a P.1 case", None, "no change here", "T47D or D614G",
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "row_id long, text string")
    found = variants.variants(rows, "text", stop=["t47d"]).select("row_id", F.inline("variants"))
    return found.select("row_id", "type", "normalized", F.col("start").alias("first"), F.col("end").alias("past"))


ARTICLE = (
    "<PubmedArticle><MedlineCitation><PMID>{pmid}</PMID><Article><Journal><Title>A Journal</Title><ISOAbbreviation>A J</ISOAbbreviation><JournalIssue><PubDate>{date}</PubDate></JournalIssue></Journal>"
    "<ArticleTitle>{title}</ArticleTitle><Abstract>{abstract}</Abstract><Language>eng</Language>{authors}<VernacularTitle>Titre</VernacularTitle>"
    "<PublicationTypeList><PublicationType UI='D1'>English Abstract</PublicationType><PublicationType UI='D2'>Review</PublicationType></PublicationTypeList></Article>{lists}</MedlineCitation>"
    "<PubmedData><History>{history}</History><ArticleIdList><ArticleId IdType='doi'>{doi}</ArticleId></ArticleIdList></PubmedData></PubmedArticle>"
)


def _article(pmid, date="<Year>2020</Year><Month>May</Month>", title="T", abstract="", authors="", lists="", history="", doi=""):
    return ARTICLE.format(**locals())


def _entry(status, y, m, d):
    return f"<PubMedPubDate PubStatus='{status}'><Year>{y}</Year><Month>{m}</Month><Day>{d}</Day></PubMedPubDate>"


@expected(
    "pubmed_id, title, abstract, CAST(y AS INTEGER) AS y, CAST(m AS INTEGER) AS m, CAST(d AS INTEGER) AS d, authors, mesh, types, doi",
    "('1', 'SARS CoV 2 in &', 'First part. x 2 end' || chr(10) || 'Second', 2020, 5, NULL, 'Ann Lee;A Group', 'D1:Y/Q1:N', 'Review', '10.1/ab')",
    "('2', 'An old title.', 'text   after', 2019, 11, NULL, '', '', 'Review', NULL)",
    "('3', 'Titre', '', 2018, 2, 3, 'Lee', '', 'Review', NULL)",
    "('5', 'T', 'a, b . c', 2017, 1, 2, '', '', 'Review', NULL)",
)
def pubmed_articles(spark, d):
    """Articles with mark-up, sections, old titles and dates of both kinds; an article without a number as its id goes."""
    author = "<AuthorList><Author><LastName>Lee</LastName>{}</Author>{}</AuthorList>"
    mesh = "<MeshHeadingList><MeshHeading><DescriptorName UI='D1' MajorTopicYN='Y'>x</DescriptorName><QualifierName UI='Q1' MajorTopicYN='N'>y</QualifierName></MeshHeading></MeshHeadingList>"
    rows = [
        _article(1, title="SARS<sub>CoV</sub>2 in &amp;amp;", abstract="<AbstractText>First\npart. x<sup>2</sup> end</AbstractText><AbstractText Label='B'>Second</AbstractText>", lists=mesh, doi="10.1/ab",
                 authors=author.format("<ForeName>Ann</ForeName>", "<Author><CollectiveName>A Group</CollectiveName></Author>"), history=_entry("pubmed", 2020, 6, 1)),
        _article(2, "<MedlineDate>2019 Nov-Dec</MedlineDate>", "[An old title].", "<AbstractText>text <xref>7</xref>(<xref>8</xref>) after</AbstractText>", doi="none/"),
        _article(3, "<Year>2018</Year><Month>06</Month>", "", "<AbstractText/>", author.format("", ""), history=_entry("medline", 2018, 1, 1) + _entry("entrez", 2018, 2, 3)),
        _article("x4"), None, "<PubmedArticleSet></PubmedArticleSet>",
        _article(5, "<Year>1500</Year>", abstract="<AbstractText>a, , b ,. c</AbstractText>", history=_entry("received", 2017, 1, 2)),
    ]
    out = pubmed.articles(spark.createDataFrame([(r,) for r in rows], "value string"))
    heads = F.array_join(F.flatten(F.transform("mesh", lambda h: F.transform(h, lambda e: F.concat_ws(":", e["id"], e["major"])))), "/")
    return out.select(
        "pubmed_id", "title", "abstract", F.col("publish_year").alias("y"), F.col("publish_month").alias("m"), F.col("publish_day").alias("d"),
        F.array_join("authors", ";").alias("authors"), heads.alias("mesh"), F.array_join("medline_pubtype", ",").alias("types"), "doi",
    )


@expected("CAST(ord AS BIGINT) AS ord, page", "(1, 'one')", "(2, 'two')", "(3, NULL)", "(4, NULL)")
def pages_by_url(spark, d):
    """What was scraped under the first of a document's sorted URLs: tidied, with its DOI's, without NCBI's and PDFs."""
    rows = [(1, "http://z ; http://b", ""), (2, "http://c.pdf; ", "10.1/x"), (3, "https://www.ncbi.nlm.nih.gov/pubmed/7", None), (4, None, None)]
    docs = spark.createDataFrame(rows, "ord long, url string, doi string").select("ord", web.candidate_urls(tx.tidy_urls(F.col("url"), F.col("doi"))).alias("urls"))
    pages = spark.createDataFrame([("http://b", "one"), ("http://z", "last"), ("https://doi.org/10.1/x", "two"), ("http://c.pdf", "no")], "u string, text string")
    return web.first_by_url(docs, pages, "urls", "u").select("ord", F.col("page.text").alias("page"))


@expected("CAST(id AS BIGINT) AS id, value, CAST(version AS BIGINT) AS version", "(1, 'a2', 5)", "(2, 'b', 1)", "(3, 'c', 9)", "(4, 'same, from the batch', 2)")
def upserted(spark, d):
    """Rows kept by key, the last by order; a new row beats an equal one."""
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (4, "same", 2)], "id long, value string, version long")
    new = spark.createDataFrame([(1, "a1", 4), (1, "a2", 5), (3, "c", 9), (2, "older", 0), (4, "same, from the batch", 2)], "id long, value string, version long")
    return incremental.upsert(old, new, "id", F.col("version"))


@expected("kind, key, CAST(n AS BIGINT) AS n", "('id', 'q1', 2)", "('name', 'same', 2)")
def name_conflicts(spark, d):
    """Ids with several names and names of one type with several ids, over all files."""
    rows = [("q1", "Drug", "a"), ("q1", "Drug", "b"), ("q2", "Drug", "same"), ("q3", "Drug", "same"), ("q4", "Virus", "same"), ("q2", "Drug", "same")]
    return release.name_conflicts(spark.createDataFrame(rows, "id string, type string, normalized string"))


@expected("path, fixed, CAST(number AS VARCHAR) AS number, target", "('b', 'a & b', '12', 'http://x/y?z=1')")
def damaged_files(spark, d):
    """Files whose MD5 is another than the published one; entities, ids and redirects in columns."""
    contents = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "z")], "path string, content string")
    sums = contents.select("path", F.when(F.col("path") == "b", "0").otherwise(F.md5("content")).alias("md5"))
    url = F.lit("http://go?redirectUrl=http%3A%2F%2Fx%2Fy%3Fz%3D1&k=2")
    out = files.damaged(contents, sums).withColumn("raw", F.lit("a &amp; b"))
    return out.select("path", readers.unescape("raw").alias("fixed"), F.coalesce(tx.numeric_id(F.lit("12")), tx.numeric_id(F.lit("x12"))).alias("number"), files.redirect_target(url).alias("target"))


@expected("CAST(ord AS BIGINT) AS ord", "(2)", "(5)")
def searched(spark, d):
    """Documents not loaded yet, by words of journal and title in any case; the queue of the loaded ones is done."""
    rows = [(1, "Nature", "a virus"), (2, "NATURE Medicine", "The Virus"), (3, "Science", "virus"), (4, "Nature", "cells"), (5, "nature", "viruses")]
    docs = spark.createDataFrame(rows, "ord long, journal string, title string").withColumn("abstract", F.lit(""))
    loaded = docs.where("ord = 1").select("ord")
    if not release.queue_is_empty(loaded, loaded, "ord"):
        raise ValueError("the loaded document is annotated")
    return release.search(docs, loaded, "ord", journal="nature", title="VIRUS").select("ord")


@expected("json", """('[{"type":"Drug","name":"b","section":"title","start":4,"end":5},{"type":"Virus","name":"a","section":"abstract","start":0,"end":1}]')""")
def mentions_json(spark, d):
    """Mentions as sorted JSON with their places."""
    e = "array<struct<type:string,normalized:string,id:string,start:int,end:int,section:string>>"
    df = spark.createDataFrame([([("Virus", "a", "x", 0, 1, "abstract"), ("Drug", "b", "y", 4, 5, "title")],)], f"entities {e}")
    return df.select(star.mentions_json().alias("json"))


@expected("id", "('1')", "('2')", "('9')")
def process_record(spark, d):
    """All ids seen by former and present runs."""
    one = lambda *xs: spark.createDataFrame([(x,) for x in xs], "id string")
    return release.process_record(one("2", "1"), one("9", None), one("1"))
