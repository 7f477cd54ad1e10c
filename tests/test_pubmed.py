import gzip

from tests import fixture_cases as fixtures
from lithos.sources import pubmed


def test_files_are_split_at_the_end_of_each_article(spark, tmp_path):
    every = [fixtures._article(i, title=f"Title <i>{i}</i>", abstract="<AbstractText>one</AbstractText>") for i in range(40)]
    page = "<?xml version='1.0'?>\n<PubmedArticleSet>\n" + "\n".join(every) + "\n</PubmedArticleSet>\n"
    (tmp_path / "a.xml").write_text(page)
    with gzip.open(tmp_path / "b.xml.gz", "wt") as f:
        f.write(page.replace("<PMID>", "<PMID>9"))
    got = pubmed.read(spark, str(tmp_path)).collect()
    assert sorted(int(r.pubmed_id) for r in got) == sorted([*range(40), *(int(f"9{i}") for i in range(40))])
    assert {(r.abstract, r.language, r.publish_year, r.publish_month) for r in got} == {("one", "eng", 2020, 5)}


def test_blocks_cut_at_separating_elements_and_leave_out_ignored_ones():
    import xml.etree.ElementTree as ET

    e = ET.fromstring("<a>head <b>bold</b> tail<p>second <xref>no</xref>x</p>rest<table>gone</table> end</a>")
    assert pubmed.blocks([e]) == ["head bold tail", "second x rest end"]
    assert pubmed.blocks([]) == []
