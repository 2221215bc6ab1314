"""SQL and plans agree on texts that hold what the invented tables lack: names, notices, keywords."""

import pytest

from pressmill.plans.catalog import QUERIES, SQL
from tests.oracle import agree

TEXTS = [
    "Jean Dupont a visité Le Havre et les états-unis avec M. Martin de Renault SA. L'ONU, l'Élysée et L'Oréal à PARIS. Parisien Niceté Aix-en-Provence; Commission européenne.",
    "Urgent: crise et guerre\n" + "Le gouvernement français parle de paix, d'accord et de progrès. " * 40,
    "Titre court\nNous écrivons pour la presse.\n\nLire aussi la tribune | Article réservé à nos abonnés\n\nLa suite du texte.",
    "Nous avons un texte long pour vous dans cette page.\nPartager cet article\nSuivez-nous sur le réseau\n1,5% de plus\n@nom\n#tag\nabc\nwww.site.fr\nFin du texte.",
    "Acesta este un articol și sunt multe.\nCitește și: Alt articol\nRestul articolului este rezervat abonațiilor.\nNu se vede.",
    "This is the text of an article about technology, innovation and climate.\nRead more here\nSubscribe to continue reading\nhidden line of text",
    "Home > News > Article\nNews | Politics\nContent line that stays.\nAdvertisement\nmore [link](http://x.y) text\nLast line stays too.",
    "bani si economie fotbal sua " * 30,
    "international mondial otan " * 40,
    "moldova iasi romania " * 40,
    "word " * 600,
    "same " * 30,
    "x",
    "",
    None,
    "  \n\t\n",
    "Line one\r\nLine two end \n\n\n\n\nLine three",
]
NAMES = [n for n in SQL if n.startswith("doc_") and n != "doc_section_overlap" or n in ("article_enriched", "site_feed_top10", "category_feed_top10", "boilerplate_lines")]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    rows = [(i, t, "fr", f"src{i % 3}") for i, t in enumerate(TEXTS + TEXTS[:9])]
    import pandas as pd

    pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source"]).to_parquet(f"{path}/documents.parquet")
    return str(path)


@pytest.mark.parametrize("name", sorted(NAMES))
def test_agree(spark, folder, name):
    agree(spark, folder, QUERIES[name], SQL[name])
