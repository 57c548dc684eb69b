from __future__ import annotations

import random

import pytest
from llm_frames import empty

from caseloom.llm import html_text
from caseloom.llm.html_text import extract, main_text

LONG = "Many words of running text that tell a story at some length, as articles do. "
CASES = [
    (f"<html><body><nav><a href=/>Home</a></nav><article><h1>T &amp; x</h1><p><b>{LONG}<br><p>B\n c&nbsp;d.</p></article><footer>f</footer>",
     f"T & x\n{LONG.strip()}\nB c d."),
    (f"<body><div class='menu'>m</div><div><p>{LONG}</p><p>{LONG * 2}</p></div><div id=sidebar>s</div><form>f</form></body>",
     f"{LONG.strip()}\n{(LONG * 2).strip()}"),
    (f"<main><p>{LONG}<script>if (a</p>b) x()</script> end</p><aside>no</aside><section id='comments'><article>me too</article></section></main>",
     f"{LONG}end"),
    (f"<div class='page no-sidebar'><header>Site</header><article><header><h1>Head</h1></header><p>{LONG}</p><div class='ad'>buy</div></article></div>",
     f"Head\n{LONG.strip()}"),
    (f"<article><p>{LONG}</p><ul><li>one<li>two</ul><table><tr><td>a<td>b</table></article>", f"{LONG.strip()}\none\ntwo\na\nb"),
    (f"<article><p>1 < 2 &lt;b&gt; {LONG}<!-- <p>x</p> --></p><div style='display: none'>h</div></article", f"1 < 2 <b> {LONG.strip()}"),
    ("", ""), (None, ""), ("<nav>only a menu</nav>", ""), ("<p", ""),
]


@pytest.mark.parametrize("page, text", CASES)
def test_main_text(page, text):
    assert main_text(page) == text


def test_links_do_not_make_an_article():
    links = "".join(f"<li><a href=/{i}>A rather long headline number {i}</a></li>" for i in range(30))
    page = f"<div><div><ul>{links}</ul></div><div><p>{LONG * 3}</p><p>{LONG * 2}</p><p>{LONG * 4}</p></div></div>"
    assert "headline" not in main_text(page) and main_text(page).count("\n") == 2


def test_deep_and_long_pages():
    assert main_text("<div>" * 20_000 + LONG) == LONG.strip()
    assert len(main_text(f"<article>{'<b><i>' * 20_000}{LONG * 2_000}")) == len(LONG) * 2_000 - 1


def test_frames(spark):
    rows = [(1, "u", CASES[0][0], "x"), (1, "u", CASES[0][0], "x"), (2, None, None, "x"), (None, "v", "", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, h string").toDF("page_id", "url", "html", "url")
    got = extract(pages).collect()
    assert sorted(((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in got)) == sorted(
        ((p or 0, u or "", main_text(h), len(main_text(h))) for p, u, h, _ in rows)
    )
    assert extract(empty(spark, "page_id long, url string, html string")).count() == 0


def random_page(rng, depth=0):
    inline = lambda: rng.choice(["<a href=/>{}</a>", "<b>{}</b>", "{}", "<i>{} </i>"]).format("word " * rng.randint(0, 12))
    if depth > 4 or rng.random() < 0.3:
        return f"<p>{''.join(inline() for _ in range(rng.randint(0, 4)))}</p>"
    tag = rng.choice(["div", "section", "article", "main", "ul", "td"])
    return f"<{tag}>" + "".join(random_page(rng, depth + 1) for _ in range(rng.randint(0, 4))) + f"</{tag}>"


def test_choice_equals_brute_force_over_all_subtrees():
    """The kept parts are those of the definition, whatever the tags are called."""
    rng = random.Random(9)
    chosen = 0
    for _ in range(400):
        nodes = html_text.parse("".join(random_page(rng) for _ in range(rng.randint(1, 4))))
        html_text.weigh(nodes)
        html_text.choose(nodes)
        usable = [n for n in nodes if not n.out and n.chars and (n.tag in html_text.BLOCK or n.parent is None)]
        if not usable:
            continue
        blocks = lambda n: [c for c in n.children if isinstance(c, html_text.Node) and not c.out and c.tag in html_text.BLOCK]
        sums = {n: sum(c.density for c in blocks(n)) if blocks(n) else n.density for n in usable}
        best = next(n for n in usable if sums[n] == max(sums.values()))  # the first of equals
        path, node = [best], best
        while node.parent:
            node = node.parent
            path.append(node)
        threshold = min(n.density for n in path)

        def within(node):
            return [node, *(x for c in node.children if isinstance(c, html_text.Node) for x in within(c))]

        reached = lambda n: all(x.density >= threshold for x in ancestors(n))
        wanted = {best}
        for n in usable:
            if n.tag in html_text.BLOCK and reached(n):
                own = [x for x in within(n) if x in sums]
                wanted.add(next(x for x in own if sums[x] == max(sums[y] for y in own)))
        assert {n for n in nodes if n.kept} == wanted
        chosen += best.tag in ("article", "main") or len(wanted) > 1
    assert chosen > 100


def ancestors(node):
    while node:
        yield node
        node = node.parent


def test_article_tags_do_not_decide():
    links = "".join(f"<li><a href=/{i}>A headline of some length {i}</a></li>" for i in range(20))
    page = f"<body><div><{{t}}><ul>{links}</ul></{{t}}></div><div><p>{LONG * 3}</p><p>{LONG * 4}</p><p>{LONG * 2}</p></div></body>"
    texts = {main_text(page.replace("{t}", tag)) for tag in ("article", "main", "div")}
    assert len(texts) == 1 and "headline" not in texts.pop()
