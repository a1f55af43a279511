import html as entities
import re

import duckdb
import pytest

from panelweave.llm import html_text
from panelweave.llm.html_text import main_text

FILL = "Plain words of an article that goes on for a while, as articles do."


def planted(page):
    """Naive text of a page of the given tables: what stands in its one article element, cut at block tags."""
    body = page.split("<article>", 1)[1].split("</article>", 1)[0].split("<footer>", 1)[0]
    blocks = re.split(r"</?(?:p|h1|article)>", body)
    texts = [" ".join(entities.unescape(re.sub(r"<[^>]*>", " " if "<br>" in b else "", b)).split()) for b in blocks]
    return "\n".join(t for t in texts if t)


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_query_equals_naive_cut_of_the_tables(spark, scale):
    sf = f"/root/testdata/{scale}"
    got = {r["page_id"]: (r["url"], r["text"], r["n_chars"]) for r in html_text.op12_html_text(spark, sf).collect()}
    rows = duckdb.sql(f"select page_id, url, html from '{sf}/pages.parquet'").fetchall()
    assert len(got) == len(rows)
    for page_id, url, page in rows:
        assert got[page_id] == (url, planted(page), len(planted(page)))


PARTS = f"""<!doctype html><html><head><title>T</title><style>p{{}}</style><script>document.write("<p>{FILL}</p>")</script></head>
<body class="has-sidebar no-comments"><div id="site-header"><h1>Site</h1>{FILL}</div><nav>{FILL}</nav><div class="cookie-notice">{FILL}</div>
%s
<div class="sideBar"><p>{FILL}</p></div><section id="comments"><article class="comment"><p>{FILL} {FILL} {FILL}</p></article></section>
<form><label>Name</label><select><option>{FILL}</select><p>{FILL}</p></form><div style="display: none">{FILL}</div>
<div role="contentinfo">{FILL}</div><footer>{FILL}</footer></body></html>"""
ARTICLE = f"<h1>Head&eacute;r</h1>\n<p>{FILL}<p>Ok.<ul><li>one<li>two <b>bo</b>ld</ul><table><tr><td>a<td>b<tr><td>c</table>" \
    f"<p>x<br>y&nbsp;z &lt;p&gt; &#65;</p><aside>{FILL}</aside><p>{FILL}</p>"  # fmt: skip
WANT = f"Headér\n{FILL}\nOk.\none\ntwo bold\na b\nc\nx y z <p> A\n{FILL}"


@pytest.mark.parametrize("wrap", ["<article>%s</article>", "<main><article class='post'>%s</article></main>", "<div role=main>%s</div>",
                                  "<main><header>%s</header></main>", "<div class=content>%s</div>", "<div><div id=x1>%s</div></div>"])
def test_page_parts(wrap):
    assert main_text(PARTS % (wrap % ARTICLE)) == WANT


def test_menus_without_names_go_with_the_ratio():
    links = "".join(f"<li><a href=/{k}>Section number {k}</a></li>" for k in range(9))
    page = f"<body><div><ul>{links}</ul></div><div><div>{ARTICLE}</div></div><div><ul>{links}</ul></div></body>"
    assert main_text(page) == WANT


@pytest.mark.parametrize(
    "page, want",
    [
        (None, ""), ("", ""), (" \n", ""), ("just  text", "just text"), ("<p>a</p>b<p>c", "a\nb\nc"),
        ("<article></article>", ""), ("<nav>a</nav>", ""), ("<article><p>a</p><p>b</p><p class='x", "a\nb"),
        ("<article><p>a</p><!-- cut <p>b</p>", "a"), ("<article><p>1 < 2 & 3</article>", "1 < 2 & 3"),
        ("<article><p><b>a</p><p>b</b></p></article></div></p>", "a\nb"), ("<script>x</script><p>y</p>", "y"),
    ],
)
def test_small_pages(page, want):
    assert main_text(page) == want


def test_rows(spark):
    long = "<article>" + f"<p>{FILL}</p>" * 20_000 + "</article>"
    rows = [(1, None, None, 7, "t"), (None, "u", "<p>a</p>", 7, "t"), (2, "u", "", 7, "t"), (2, "u", long, 7, "t"), (2, "u", "", 7, "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars long, text string")
    got = sorted(map(tuple, html_text.extract(pages).collect()), key=str)
    text = "\n".join([FILL] * 20_000)
    assert got == sorted([(1, None, "", 0), (None, "u", "a", 1), (2, "u", "", 0), (2, "u", text, len(text)), (2, "u", "", 0)], key=str)
    assert html_text.extract(pages.limit(0)).collect() == []


def test_the_ratio_and_the_smoothing_decide(monkeypatch):
    """Without threshold clustering the region is another."""
    page = f"<div><div>{''.join(f'<p><i>s</i> <u>t</u> <b>{k}</b></p>' for k in range(300))}</div><div><p>{FILL * 9}</p><p>{FILL * 9}</p></div></div>"
    assert main_text(page) == f"{FILL * 9}\n{FILL * 9}"
    monkeypatch.setattr(html_text, "content_lines", lambda ratios, sigma: ratios >= 0)
    assert main_text(page) != f"{FILL * 9}\n{FILL * 9}"
