"""Main text, token counts, decontamination and secrets on small texts, against brute force."""

import hashlib
import itertools
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tierline.llm.decontaminate import MASKS, Index, drop_contaminated, find_overlaps, words
from tierline.llm.decontaminate import words as words_of
from tierline.llm.html_text import LEAST_PAGES, SUPPORT, extract_text, host_templates, main_text, page_tokens
from tierline.llm.secrets import RULES, find_secrets, trigram_query
from tierline.llm.shingles import WordHashes
from tierline.llm.tokens import LongestMatch, count_tokens

# Main text


def page(i, extra=""):
    return (
        f"<html><head><title>t{i}</title><style>p{{}}</style></head><body><header><h1>Site</h1></header>"
        f'<div id="nav-bar"><a href=x>Home</a> <a>About</a></div><div class="content"><h2>Title {i}</h2>'
        f"<p>Body &amp; text {i} one.</p><p>Second \n\t par&eacute; {i * 7}<br>two</p>{extra}<p>Share this article</p></div>"
        f'<div class="sidebar"><p>side {i}</p></div><div class="comments"><p>I like {i}</p></div>'
        f"<form><p>sub</p></form><script>var a='</p>';</script><footer>&copy; {i}</footer></body></html>"
    )


def test_template_without_article(spark):
    rows = [(i, f"http://h.org/{i}", page(i)) for i in range(6)]
    rows += [(6, "http://h.org/6", page(6, '<div class="ad">Buy</div><p>More<form>mail</form>'))]
    got = {r["page_id"]: r for r in extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(6):
        assert got[i]["text"] == f"Title {i}\nBody & text {i} one.\nSecond paré {i * 7} two"
        assert got[i]["n_chars"] == len(got[i]["text"])
    assert got[6]["text"].endswith("two\nMore")


def test_article_and_edges(spark):
    article = "<body><nav>menu</nav><article><h1>T</h1><p><b>first<br><p>second<aside>x</aside></article><footer>f"
    rows = [(1, "http://a.org/1", article), (2, None, None), (3, "nonsense", ""), (None, "http://a.org/2", "<p>a<p>b")]
    rows += [(5, "http://a.org/3", "1 < 2 &lt; 3 <!-- no --> &copy"), (5, "http://a.org/3", "<p " * 2000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    got = [(r["page_id"], r["url"], r["text"]) for r in extract_text(df).collect()]
    assert len(got) == len(rows)
    assert (1, "http://a.org/1", "T\nfirst\nsecond") in got
    assert (2, None, "") in got and (3, "nonsense", "") in got
    assert (None, "http://a.org/2", "a\nb") in got
    assert (5, "http://a.org/3", "1 < 2 < 3 ©") in got
    assert extract_text(df.where("false")).count() == 0


def test_parts_of_an_article():
    text = main_text(
        '<body><div class="cookie-notice">We use cookies</div><main><article class="post comment-open"><div class="entry-header">'
        '<h1 class="page-header">Title</h1></div><p>One<b> two</b>\n three</p><ul><li>a<li>b</ul><table><tr><td>c<td>d</table>'
        '<div id="ad-7">Buy</div><section class="notice">Old</section><form><input value=x>mail</form><figure><img><figcaption>cap'
        '</figcaption></figure><pre>x  y</pre><aside>more</aside><section id="comments"><p>Nice!</p></section></article></main>'
        '<aside><article><h2>Other</h2></article></aside><footer>f</footer>',
        None,
    )
    assert text.split("\n") == ["Title", "One two three", "a", "b", "c", "d", "cap", "x y"]


def test_names_of_wrappers():
    """Names of elements around the article, or around its whole text, do not drop it."""
    text = "<p>" + "Long text of the article. " * 20 + "</p>"
    aside = '<div class="sidebar"><p>side</p></div><div id="comments"><p>Nice! Nice!</p></div><div class="share-bar"><p>share</p></div>'
    for name in ("site has-sidebar", "elementor-widget elementor-widget-text-editor", "ad-free", "widget"):
        page = f'<body><div class="{name}"><article><h1>Title</h1>{text}</article>{aside}</div><footer>f</footer>'
        assert main_text(page, None).split("\n")[1:] == [("Long text of the article. " * 20).strip()], name
    for name in ("elementor-widget-text-editor", "ad-free"):
        page = f'<body><main><h1>Title</h1><div class="{name}">{text}<div class="ad">Buy</div></div>{aside}</main>'
        assert main_text(page, None).split("\n") == ["Title", ("Long text of the article. " * 20).strip()], name
    page = f'<body><main><p>Short.</p><div class="comments-area">{text}</div></main>'
    assert main_text(page, None) == "Short."


def test_template_inside_articles(spark):
    """Texts that a host repeats inside its articles are template; copies of one page are not."""
    bare = "<body><article><h1>T {0}</h1><p>Text {0} here.</p><p>Read more on our site</p><div>By the staff</div></article>"
    plain = "<body><div><div><p>Menu</p></div><div><p>First {0} of many words.</p><p>Second {0} of many words.</p></div></div>"
    rows = [(i, f"http://a.org/{i}", bare.format(i)) for i in range(5)]
    rows += [(i, f"http://b.org/{i}", plain.format(max(i, 16))) for i in range(10, 20)]
    rows += [(i, f"http://c.org/{i}", bare.format(0)) for i in range(20, 26)]
    got = {r["page_id"]: r["text"] for r in extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(5):
        assert got[i] == f"T {i}\nText {i} here."
    for i in range(10, 20):
        n = max(i, 16)
        assert got[i] == f"First {n} of many words.\nSecond {n} of many words."
    for i in range(20, 26):
        assert got[i] == "T 0\nText 0 here.\nRead more on our site\nBy the staff"


def extracted(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r["page_id"]: r["text"].split("\n") for r in extract_text(df).collect()}


def test_texts_that_articles_share(spark):
    """Near-copies keep all their text, and so do repeated headings and sentences inside articles."""
    frame = "<html><body><nav>Menu</nav><article>{}</article><footer>f</footer></body></html>"
    shared = [f"Paragraph {k} of an article that was copied." for k in range(5)]
    copy = ["The title", *shared]
    pages = {i: [*copy, f"Edited on day {i}"] for i in range(3)}
    pages |= {i: [f"Title {i}", f"Another text {i}.", f"And more {i}."] for i in range(3, 6)}
    pages |= {
        i: [f"Soup {i}", "Ingredients", f"{i} onions", "Method", "Preheat the oven to 180 degrees.", f"Serve {i}."]
        for i in range(10, 14)
    }
    pages |= {i: [*copy, f"Edited on day {i}"] for i in range(20, 26)}
    rows = [(i, f"http://h{i // 10}.org/{i}", frame.format("".join(f"<p>{t}</p>" for t in page))) for i, page in pages.items()]
    assert extracted(spark, rows) == pages


def test_slots_from_classes_alone(spark):
    """No article element and no telling name: what repeats on a host, and the short slots beside, are no article."""
    html = (
        '<html><body><div class="k1"><p>Daily News</p><p>Home Sport Money</p></div><div class="k2"><div class="k3">'
        "<h1>Title {0}</h1><p>First paragraph {0} with a number of words.</p><p>Second paragraph {0} with more of them.</p>"
        '<p>Third one.</p><p>End {0}.</p><p>All rights kept</p></div></div><div class="k4"><p>Weather {0}</p></div></body></html>'
    )
    got = extracted(spark, [(i, f"http://h.org/{i}", html.format(i)) for i in range(8)])
    for i in range(8):
        text = [f"First paragraph {i} with a number of words.", f"Second paragraph {i} with more of them."]
        assert got[i] == [f"Title {i}", *text, "Third one.", f"End {i}."]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcdef"), max_size=8), min_size=1, max_size=8))
def test_classes_by_vectors(spark, pages):
    """Tokens share a class if, and only if, they occur equally often on every page."""
    rows = [("h", tag, "<div>" + "".join(f"<i{c}>{c}</i{c}>" for c in page) + "</div>") for tag, page in enumerate(pages)]
    tokens = page_tokens(spark.createDataFrame(rows, "host string, tag long, html string"))
    vectors = {}
    for r in tokens.where("token <> ''").collect():
        vectors.setdefault(r["token"], {})[r["tag"]] = r["n"]
    want = {}
    for token, vector in vectors.items():
        if len(vector) >= max(LEAST_PAGES, SUPPORT * len(pages)):
            want.setdefault(tuple(sorted(vector.items())), set()).add(token)
    got = {}
    for row in host_templates(tokens).collect():
        for t in row["tokens"]:
            got.setdefault(t["group"], set()).add(t["token"])
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet='<>/"\'=!-pdivabscriptarticle &;#x \n', max_size=80))
def test_any_markup(text):
    assert isinstance(main_text(text, None), str)


# Token counts


def greedy(word, vocabulary):
    n = at = 0
    while at < len(word):
        ends = [e for e in range(len(word), at, -1) if word[at:e] in vocabulary]
        if not ends:
            return 1
        at, n = ends[0], n + 1
    return n


@settings(max_examples=300, deadline=None)
@given(
    st.sets(st.text(alphabet="abc", min_size=1, max_size=5).map(str.encode), max_size=12),
    st.lists(st.text(alphabet="abc", max_size=12).map(str.encode), max_size=5),
    st.booleans(),
)
def test_longest_match(vocabulary, found, whole):
    if whole:
        vocabulary |= {b"a", b"b", b"c"}
    automaton = LongestMatch(sorted(vocabulary))
    for word in found:
        assert automaton.count(word) == (greedy(word, vocabulary) if word else 0)


def test_token_rows(spark):
    rows = [(1, "ab  ab\nb", 0), (None, None, 0), (3, "", 0), (3, " \t ", 0), (4, "é", 0), (5, "ab " * 5000, 0)]
    df = spark.createDataFrame(rows, "id long, text string, n_words int")
    got = sorted(count_tokens(df, [b" a", b" ", b"b", b"ab"]).collect(), key=str)
    want = [(1, 3, 6), (3, 0, 0), (3, 0, 0), (4, 1, 1), (5, 5000, 10000), (None, 0, 0)]
    assert [tuple(r) for r in got] == want


# Decontamination


def test_overlaps(spark, words):  # noqa: F811
    item, other, short = words[:40], words[40:80], words[80:86]
    changed = [w if i % 6 else "zzz" for i, w in enumerate(item)]
    filler = words[200:300]
    texts = {
        1: filler + item + filler,
        2: filler + changed,
        3: item[:25],
        4: item[:9] + filler,
        5: [w.upper() + "!" for w in other],
        6: filler + short,
        7: filler,
        8: item[::-1],
        9: filler * 300 + item,
    }
    docs = [(k, " ".join(v)) for k, v in texts.items()] + [(10, None), (11, ""), (1, " ".join(texts[1]))]
    items = [(1, " ".join(item)), (2, " ".join(other)), (3, " ".join(short)), (4, "a b"), (None, None)]
    d = spark.createDataFrame(docs, "id long, text string")
    b = spark.createDataFrame(items, "id long, text string")
    for block in (20_000, 2):
        got = sorted((r["doc_id"], r["item_id"]) for r in find_overlaps(d, b, block).collect())
        assert got == [(1, 1), (1, 1), (2, 1), (3, 1), (5, 2), (6, 3), (9, 1)]
    full = spark.createDataFrame([(*r, None) for r in docs], "doc_id long, text string, words int")
    kept = drop_contaminated(full, b, 2)
    assert kept.columns == full.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [4, 7, 8, 10, 11]
    assert find_overlaps(d.where("false"), b).count() == 0
    assert find_overlaps(d, b.where("false")).count() == 0


def test_seeds_tolerate_substitutions(words):  # noqa: F811
    """Every mask finds the passage if only places that it ignores were replaced."""
    for mask in MASKS:
        item = words[:30]
        text = [w if mask[i % len(mask)] == "1" else "zzz" for i, w in enumerate(item)]
        index = Index([(1, " ".join(item))], percent=30)
        from tierline.llm.decontaminate import words as hashed

        assert index.overlaps(hashed(" ".join(text), WordHashes())), mask


def test_short_items_with_any_words_replaced(words):  # noqa: F811
    """An item of any length below 13 is found wherever a fifth of its words, rounded down, is replaced, and not with one more."""
    cache = WordHashes()
    for n in range(1, 14):
        item = words[:n]
        index = Index([(1, " ".join(item)), (2, " ".join(words[50:90]))])
        for k in (n // 5, n // 5 + 1):
            for at in itertools.combinations(range(n), k):
                text = words[100:103] + ["zzz" if i in at else w for i, w in enumerate(item)] + words[103:106]
                hits = index.overlaps(words_of(" ".join(text), cache))
                assert hits == ([(1, 3, 0, n, n - k)] if k == n // 5 else []), (n, at)


def test_scripts_without_white_space():
    cache, item = WordHashes(), "今日は天気がいいので散歩に行きましょう"
    index = Index([(1, item), (2, "東京")])
    assert [h[0] for h in index.overlaps(words_of("前の文。" + item.replace("散", "運") + "。次の文", cache))] == [1]
    assert [h[0] for h in index.overlaps(words_of("私は東京です", cache))] == [2]
    assert index.overlaps(words_of("全然違う話です", cache)) == []


# Secrets

BASE = (
    ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 8),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 32),
)


def spans(text):
    return sorted((m.start(), k, m.end()) for k, (_, rx, ok) in enumerate(BASE) for m in rx.finditer(text or "") if ok(m))


def test_secret_spans(spark):
    texts = [
        None, "", "password", "PassWord = 'abcdefgh' and token:\"x\"", "api_key:token:abcdefgh1 APIKEY=12345678",
        "secret=token=abcdefghij", "é😀 passwd : longenough1 é", "AKIA" + "B" * 12, "AKIAAKIA" + "C" * 7, "AKIA" + "B" * 11,
        "xAKIA" + "0" * 40 + "y", "f" * 31, "g" + "0a" * 16 + "g", "0" * 100 + " token=" + "a" * 40, "tok en=abcdefgh",
        "password=short password=longenough password = longenough2", "x " * 4000 + "token=abcdefgh " * 300,
    ]
    rows = [(i, t, "k") for i, t in enumerate(texts)] + [(None, texts[3], "k"), (0, texts[3], "k"), (3, texts[3], "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = find_secrets(df).collect()
    want = [(i, spans(t)) for i, t, _ in rows]
    assert sorted(((r["doc_id"], [tuple(s) for s in r["spans"]]) for r in got), key=str) == sorted(want, key=str)
    assert find_secrets(df.where("false")).count() == 0
    plan = find_secrets(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_trigram_queries():
    assert trigram_query("[0-9a-f]{32,}") == set()
    assert trigram_query("x(abc|d.f)y") == set()
    assert trigram_query("AKIA[A-Z]+") == {frozenset({frozenset({"aki", "kia"})})}
    (clause,) = trigram_query("(abcd|xyz)[0-9]+")
    assert clause == {frozenset({"abc", "bcd"}), frozenset({"xyz"})}


@settings(max_examples=200, deadline=None)
@given(st.from_regex(re.compile(RULES[0].pattern), fullmatch=True))
def test_queries_miss_no_match(text):
    low = text.lower()
    for clause in trigram_query(RULES[0].pattern):
        assert any(all(g in low for g in grams) for grams in clause)


def test_secret_query(spark, sf_dir):
    from tierline.llm.secrets import op8_secret_trigrams

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in op8_secret_trigrams(spark, sf_dir).collect():
        found = spans(docs[r["doc_id"]])
        text = ",".join(f"{BASE[k][0]}:{a}:{b}" for a, k, b in found)
        assert (r["spans"], r["base_sha256"]) == (text, hashlib.sha256(text.encode()).hexdigest())
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == i for _, k, _ in found) for i in range(3)]
