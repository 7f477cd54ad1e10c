"""What scraped pages add to documents: abstracts, journals and article types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lithos.functions.text import dash_fold, has_cjk, strip, strip_tags
from lithos.session import staged

# Page tags that hold abstracts, journals and kinds of article, in the order in which they count.
ABSTRACT_TAGS = ("Abstract", "DC.Description.Abstract", "DC.abstract", "abstract", "citation_abstract", "eprints.abstract")
JOURNAL_TAGS = ("citation_journal_title", "journal_title", "journal", "journalName", "wkhealth_journal_title")
KIND_TAGS = (
    "DC.Subject", "DC.Type.articleType", "DC.subject", "WT.cg_s", "WT.z_cg_type", "WT.z_primary_atype", "article:section", "articleType",
    "category", "citation_article_type", "citation_categories", "citation_keywords", "citation_section", "dc.Type", "dc.type", "prism.section",
    "wkhealth_toc_section", "wkhealth_toc_sub_section", "article-header__journal", "primary-heading",
)
# What those tags say for each kind, in lower case.
KIND_NAMES = {
    "Retracted": ("retraction",),
    "Erratum": ("erratum", "correction"),
    "News": ("news",),
    "Comment/Editorial": (
        "editorial", "editorialnotes", "commentary", "viewpoint", "comments & opinion", "comment", "perspective", "article commentary", "reply",
        "editorials", "correspondence response", "perspectives", "opinion piece", "n-perspective", "letter to the editor", "letters to the editor",
        "editorial/personal viewpoint", "guest editorial", "ce - letter to the editor", "world view", "current opinion", "rapid response opinion",
        "commentaries", "invited commentary", "article-commentary",
    ),
    "Book chapter": ("chapter",),
    "Meta-analysis": ("meta-analysis",),
    "Review": ("review article", "reviewpaper", "review", "review-article", "reviews", "short review", "summary review"),
    "Research": ("case report", "case-report", "clinical case report", "research-article", "research", "research letter", "original research"),
}
# What the tags of one journal say beside those.
JOURNAL_KIND_NAMES = {"Science": {"Comment/Editorial": ("letter",)}}
# Publication types that show a kind.
PUBTYPES = {
    "Retracted": ("Retracted Publication", "Retraction of Publication"),
    "Erratum": ("Published Erratum",),
    "News": ("News", "Newspaper Article"),
    "Comment/Editorial": ("Editorial", "Comment"),
    "Meta-analysis": ("Systematic Review", "Meta-Analysis"),
    "Research": ("Case Reports",),
}
# How the titles of a kind begin.
TITLES = {"Retracted": "(?i)^(retraction|retracted|withdrawn)", "Erratum": "(?i)^(erratum|correction)", "Book chapter": "^Chapter "}
# Journals whose names hold one of these keep them.
PREPRINT_NAMES = ("arxiv", "medrxiv", "biorxiv", "chemrxiv")


def _values(meta: Column, tags: tuple[str, ...]) -> Column:
    return F.flatten(F.array(*[F.coalesce(meta[t], F.array().cast("array<string>")) for t in tags]))


def backfilled_abstract(abstract: Column, meta: Column) -> Column:
    """The abstract, or else the longest one of the page's tags that has over 100 characters and is neither code nor CJK; of equals the least."""
    found = F.transform(_values(meta, ABSTRACT_TAGS), lambda x: strip(strip_tags(dash_fold(x))))
    found = F.filter(found, lambda x: ~x.startswith("//") & (F.length(x) > 100) & ~has_cjk(x))
    best = F.get(F.array_sort(F.transform(found, lambda x: F.struct((-F.length(x)).alias("n"), x.alias("x")))), F.lit(0))["x"]
    return F.coalesce(F.nullif(abstract, F.lit("")), best, F.lit(""))


def web_journal(docs: DataFrame, ord_col: str = "ord") -> DataFrame:
    """``docs`` with the journal's name on its page, or else the name most pages of that journal give (the first seen of equals).

    Preprint servers and journals of three characters or fewer give no names. Preprint servers get none,
    short ones and those without a name of their own the common name, if there is one.
    """
    served = F.lower("journal").rlike("|".join(PREPRINT_NAMES))
    name = F.get(F.filter(F.transform(_values(F.col("meta"), JOURNAL_TAGS), dash_fold), lambda x: ~has_cjk(x)), F.lit(0))
    rows = docs.withColumn("__own", F.when(~served & (F.length("journal") > 3), name)).withColumn("__low", F.lower("journal"))
    counts = rows.where("__own is not null").groupBy("__low", "__own").agg(F.count("*").alias("n"), F.min(ord_col).alias("f"))
    mode = counts.groupBy(F.col("__low").alias("__m")).agg(F.max_by("__own", F.struct("n", -F.col("f"))).alias("__mode"))
    rows = rows.join(mode, F.col("__low") == F.col("__m"), "left")
    return rows.withColumn("journal", F.coalesce("__own", "__mode", "journal")).drop("__own", "__low", "__m", "__mode")


def inferred_article_type(title: Column, meta: Column, pubtypes: Column, journal: Column | None = None) -> Column:
    """The first kind, in the order of KIND_NAMES, that page tags under 50 characters, publication types or the title show; else null."""
    tags = F.transform(F.filter(_values(meta, KIND_TAGS), lambda x: F.length(x) < 50), lambda x: F.lower(strip(dash_fold(x))))
    own = F.coalesce(pubtypes, F.array().cast("array<string>"))
    one = lambda xs: F.array(*[F.lit(x) for x in xs])
    kinds = []
    for kind, names in KIND_NAMES.items():
        test = F.arrays_overlap(tags, one(names))
        for name, more in JOURNAL_KIND_NAMES.items() if journal is not None else ():
            if kind in more:
                test = test | ((journal == name) & F.arrays_overlap(tags, one(more[kind])))
        if kind in PUBTYPES:
            test = test | F.arrays_overlap(own, one(PUBTYPES[kind]))
        if kind in TITLES:
            test = test | title.rlike(TITLES[kind])
        if kind == "Research":
            test = test | F.exists(own, lambda x: x.contains("Clinical Trial"))
        kinds.append(F.when(F.coalesce(test, F.lit(False)), F.lit(kind)))
    return F.coalesce(*kinds)


def candidate_urls(urls: Column) -> Column:
    return F.filter(urls, lambda u: (u != "") & ~u.contains("ncbi.nlm.nih.gov") & ~u.endswith(".pdf"))


def first_by_url(docs: DataFrame, pages: DataFrame, urls: str, url: str, ord_col: str = "ord") -> DataFrame:
    """``docs`` with what ``pages`` holds under the first of its sorted URLs that is there."""
    each = docs.select(F.col(ord_col).alias("__o"), F.posexplode(F.array_sort(F.col(urls))).alias("__p", url))
    value = F.struct(*[c for c in pages.columns if c != url])
    found = each.join(pages, url).groupBy("__o").agg(F.min_by(value, "__p").alias("page"))
    return docs.join(found, F.col(ord_col) == F.col("__o"), "left").drop("__o")


def transitive(spark_edges: DataFrame, root, child: str = "child", parent: str = "parent") -> DataFrame:
    """``(node, depth)`` of all classes below ``root``, by breadth-first joins until no new one comes."""
    spark = spark_edges.sparkSession
    seen = spark.createDataFrame([(root, 0)], f"node {dict(spark_edges.dtypes)[parent]}, depth int")
    edge, depth = seen, 0
    while not edge.isEmpty():
        depth += 1
        edge = edge.join(spark_edges, F.col("node") == F.col(parent)).select(F.col(child).alias("node"), F.lit(depth).alias("depth")).distinct()
        edge = staged(edge.join(seen.select("node"), "node", "left_anti"), "classes")
        seen = seen.unionByName(edge)
    return seen


def protein_phrases(viruses: DataFrame, proteins: DataFrame, templates: list[str] = ("{v} {p}", "{p} of {v}", "{v} {p} protein")) -> DataFrame:
    """``(id, alias)``: every alias of a virus with every alias of its proteins in each phrase.

    ``proteins`` has (id, aliases) and, where each belongs to one virus, ``virus``, that one's id; without
    that column every protein belongs to every virus, which a dictionary of a few thousand terms bears.
    """
    v = viruses.select(F.col("id").alias("virus"), F.explode("aliases").alias("v"))
    owned = "virus" in proteins.columns
    p = proteins.select(F.col("id").alias("protein"), F.explode("aliases").alias("p"), *(["virus"] if owned else []))
    forms = F.array(*[F.replace(F.replace(F.lit(t), F.lit("{v}"), F.col("v")), F.lit("{p}"), F.col("p")) for t in templates])
    both = v.join(p, "virus") if owned else v.crossJoin(p)
    return both.select(F.concat_ws("|", "virus", "protein").alias("id"), F.explode(forms).alias("alias")).distinct()
