import pytest

from cuecards.llm.htmltext import extract, main_text

CASES = [
    (None, ""), ("", ""), ("<div></div>", ""), ("plain text &amp; more", "plain text & more"), ("<p>a<p>b", "a\nb"),
    ("<p>x &lt;b&gt; &amp;amp; &nbsp; y</p><script>if(a<b){'</p>'}</script>", "x <b> &amp; y"), ("<!-- open <p>a</p>", ""),
    ("< a < b", "< a < b"), ('<p title="a>b">ok</p>', "ok"), ("<p>one<br>two <i>th</i>ree</p>", "one two three"),
    ("<title>t</title><style>p{}</style><p>Body text.</p>", "Body text."),
    ("<html><body><header>Site</header><div class='cookie notice'>We use cookies.</div><article><header><h1>Title</h1></header>"
     "<p>Long text, with <i>some</i> marks. And more; yes.</p><ul><li>one</li><li>two</li></ul>"
     "<section class='comments'><p>A reader, who shouts!</p></section></article><aside>side</aside><form>f<input></form>"
     "<footer>&copy; us</footer></body></html>", "Title\nLong text, with some marks. And more; yes.\none\ntwo"),
    ("<div id=nav><a href=x>a</a></div><div><h2>Head</h2><p>Real text one, long enough to be it. Yes, it is.</p><p>Short.</p></div>"
     "<div><a>link one</a> <a>link two</a></div>", "Head\nReal text one, long enough to be it. Yes, it is.\nShort."),
]


@pytest.mark.parametrize("page,text", CASES)
def test_typed_pages(page, text):
    assert main_text(page) == text


BODY = "".join(f"<p>Sentence number {i}, with a comma and more words in it.</p>" for i in range(5))


@pytest.mark.parametrize("outer", [
    '<article class="commentary">{}</article>', '<article class="post comments-open">{}</article>',
    '<div class="social-policy-article">{}</div>', '<div class="content share-enabled">{}</div>', '<section class="has-sidebar">{}</section>',
    '<form method=post>{}</form>', '<form><div id=wrap><article>{}</article></div></form>', '<aside><main>{}</main></aside>',
    '<div class="modal"><main>{}</main></div>', '<article><div class="no-ads">{}</div></article>',
    "<article>{}<p class=notice>Sentence number 5, with a comma.</p></article>"])
def test_a_name_or_a_form_around_the_article_drops_nothing(outer):
    got = main_text(f"<html><body class='modal-open'><nav>a b</nav>{outer.format('<h1>Head</h1>' + BODY)}<footer>f</footer></body></html>")
    assert got.count("Sentence number") == 5 + outer.count("Sentence") and got.startswith("Head")


@pytest.mark.parametrize("inner", [
    '<div class="userComments">{}</div>', '<div id="discussion">{}</div>', '<div class="left-rail">{}</div>', '<ul class="replies">{}</ul>',
    '<section class="comment-list"><article>{}</article></section>', '<article class="comment">{}</article>', "<form>{}</form>",
    '<aside>{}</aside>', '<div role=complementary>{}</div>', '<div class="related-posts">{}</div>', "<div hidden>{}</div>",
    '<div class="ad728 box">{}</div>', "<footer><p>{}</p></footer>"])
@pytest.mark.parametrize("inside", [True, False])
def test_what_is_no_article_goes_even_if_it_is_long(inner, inside):
    other = inner.format("<p>A reader says this, loudly; and that!</p>" * 40)
    page = f"<article><h1>Head</h1>{BODY}{other}</article>" if inside else f"<article><h1>Head</h1>{BODY}</article>{other}"
    got = main_text(f"<body>{page}</body>")
    assert got.count("Sentence number") == 5 and "reader" not in got


def test_words_kept_and_leaked_on_a_generated_site():
    """Planted article and other words under many class names."""
    rng = __import__("random").Random(7)
    good = ["post", "entry-content", "article-body", "story", "text", "has-comments", "share-enabled", "page", "news-item", "commentary", "notice-period"]
    bad = ["sidebar", "comment-list", "userComments", "cookie-notice", "main-nav", "footer-links", "ad-container", "newsletter-signup", "share-buttons",
           "related-posts", "breadcrumb", "left-rail", "promo-box", "discussion", "widget"]
    kept = leaked = n_good = n_bad = 0
    for _ in range(200):
        def words(tag, n):
            return " ".join(f"{tag}{rng.randrange(1000)}{rng.choice(['', ',', '.'])}" for _ in range(n))

        outer = rng.choice(["article", "main", "div", "section"])
        paras = "".join(f"<p class='{rng.choice(good)}'>{words('good', rng.randrange(15, 80))}</p>" for _ in range(rng.randrange(4, 12)))
        if rng.random() < 0.3:
            paras += f"<div class='{rng.choice(good)}'><ul>" + "".join(f"<li>{words('good', 8)}</li>" for _ in range(4)) + "</ul></div>"
        page = f"<{outer} class='{rng.choice(good)} {rng.choice(good)}' id='{rng.choice(good)}'><h2>{words('good', 5)}</h2>{paras}</{outer}>"
        for _ in range(rng.randrange(1, 6)):
            block = f"<div class='{rng.choice(bad)}'><p>{words('bad', rng.randrange(3, 60))}</p></div>"
            page = page + block if rng.random() < 0.5 else block + page
        page = f"<form id=aspnet>{page}</form>" if rng.random() < 0.2 else page
        got = main_text(f"<html><body><nav>{words('bad', 9)}</nav>{page}<footer>{words('bad', 20)}</footer></body></html>")
        n_good, n_bad = n_good + page.count("good"), n_bad + page.count("bad") + 29
        kept, leaked = kept + got.count("good"), leaked + got.count("bad")
    assert kept >= 0.98 * n_good and leaked <= 0.02 * n_bad


def test_headings_of_short_articles_stay():
    body = "".join(f"<p>Sentence number {i}, with a comma and more words in it.</p>" for i in range(50))
    page = f"<nav><ul><li><a>x</a></li></ul></nav><div class=ad>Buy, now!</div><article><h1>Head</h1>{body}</article><footer>f</footer>"
    assert main_text(page).startswith("Head\nSentence number 0,") and main_text(page).count("\n") == 50


@pytest.mark.parametrize("chars", [5_000, 20_000, 100_000])
@pytest.mark.parametrize("outer", ["article", "main", "div"])
def test_a_huge_block_leaves_the_paragraphs(chars, outer):
    body = "".join(f"<p>{f'Paragraph {i}, ' + 'word ' * 37}.</p>" for i in range(60))
    for tag in ("pre", "blockquote", "div"):
        page = f"<{outer}><h1>Head</h1>{body}<{tag}>{'code; line ' * (chars // 11)}</{tag}></{outer}>"
        assert main_text(page).count("Paragraph") == 60 and main_text(page).count("code; line") == chars // 11


def test_cells_of_a_large_table_stay_in_an_article():
    body = "".join(f"<p>{f'Paragraph {i}, ' + 'word, ' * 100}.</p>" for i in range(60))
    cells = "<tr>" + "<td>12345</td>" * 10 + "</tr>"
    got = main_text(f"<article>{body}<table>{cells * 200}</table></article>")
    assert got.count("Paragraph") == 60 and got.count("12345") == 2000


def test_long_and_hostile_pages_take_linear_time():
    assert main_text("<div>" * 20_000 + "x") == "x"
    assert main_text("<a " * 50_000 + '"' * 1000) is not None
    assert len(main_text("<p>" + "word, " * 100_000)) == 599_999


def test_rows_stay_rows(spark):
    schema = "page_id long, url string, html string, page string, text int"
    rows = [(1, "u", CASES[-1][0], "x", 1), (1, "u", CASES[-1][0], "x", 1), (None, None, None, "x", 1)]
    got = extract(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.page or 0, r.text) for r in got) == [(0, ""), (1, CASES[-1][1]), (1, CASES[-1][1])]
    assert extract(spark.createDataFrame([], schema)).collect() == []
