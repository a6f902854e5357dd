"""Templates against a version that gathers whole occurrence vectors, and texts with the article marks taken away."""

from collections import Counter, defaultdict

from pyspark.sql import functions as F

from quillframe.llm import html_template

from .test_cases import extracted

SF = "/root/testdata/sf0.001"


def plain_constant(sources: list[str]) -> set[int]:
    """The constant text tokens of one host, from whole vectors."""
    parsed = [html_template.parsed(s) for s in sources]
    pages = len(parsed)
    vectors, places, words = defaultdict(lambda: [0] * pages), defaultdict(list), {}
    for i, page in enumerate(parsed):
        first = {}
        for place, (token, n) in enumerate(zip(page[0], page[1])):
            vectors[token][i] += 1
            words[token] = n
            first.setdefault(token, place)
        for token, place in first.items():
            places[token].append(place)
    classes = defaultdict(list)
    for token, vector in vectors.items():
        held = sum(n > 0 for n in vector)
        if held > 1 and 2 * held >= pages:
            classes[tuple(vector)].append(token)
    size = lambda tokens: sum(max(words[t], 1) for t in tokens)
    large = [(v, sorted(t, key=lambda t: (sum(places[t]) / len(places[t]), t))) for v, t in classes.items() if size(t) >= 2]
    # The root class: once in a page, in the most pages, with the most elements and words.
    large.sort(key=lambda c: (max(c[0]) > 1, -sum(n > 0 for n in c[0]), -size(c[1])))
    known = {t: (i, rank) for i, (_, tokens) in enumerate(large) for rank, t in enumerate(tokens, 1)}
    found = defaultdict(Counter)
    for page in parsed:
        for token, gap in html_template.gaps(page[0], known).items():
            if gap >= 0:
                found[token][gap] += 1
    held = {t: max(c.values()) for t, c in found.items()}
    out = set()
    for _, tokens in large:
        ordered = [t for t in tokens if 2 * held.get(t, 0) >= pages]
        if size(ordered) >= 2:
            out |= {t for t in ordered if words[t] and 10 * held[t] >= 8 * pages}
    return out


def test_templates_equal_plain_vectors(spark):
    hosts = defaultdict(list)
    notice = "Everything here belongs to those who wrote it"
    for i in range(7):
        hosts["a.org"].append(f"<body><div class='t'><p>Our place</p></div><div class='x'><p>Own words {i}</p><p>more of {i}</p></div><div class='n'><p>{notice}</p></div></body>")
        hosts["b.org"].append(f"<body><article><h1>Title {i}</h1><div class='same'><p>Read this as well</p></div><p>Text {i}</p></article><div><p>{notice}</p></div></body>")
    hosts["c.org"] = hosts["a.org"][:1]
    hosts["d.org"] = [hosts["a.org"][0], hosts["b.org"][0], ""]
    rows = [(i, f"http://{h}/{i}", s) for i, (h, s) in enumerate((h, s) for h, all_of in hosts.items() for s in all_of)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    given = frame.select(F.split("url", "/")[2].alias("_host"), F.xxhash64("page_id").alias("_uid"), "html")
    pages = html_template.parse_pages(given, "html", ["_host", "_uid"])
    got = {r.host: set(r.constant) for r in html_template.deduce(pages).collect()}
    assert got == {h: c for h, s in hosts.items() if (c := plain_constant(s))}
    assert len(got["a.org"]) == 2 and "c.org" not in got


def test_texts_of_given_pages_equal_plain_templates(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()
    hosts = defaultdict(list)
    for r in rows:
        hosts[r.url.split("://", 1)[-1].split("/")[0].split("?")[0].split("#")[0].lower()].append(r)
    want = {}
    for pages in hosts.values():
        constant = frozenset(plain_constant([r.html or "" for r in pages]))
        want |= {r.page_id: html_template.main_text(*html_template.parsed(r.html)[2:], constant) for r in pages}
    frame = spark.createDataFrame(rows)
    assert {r.page_id: r.text for r in html_template.extract(frame, keep=["page_id"]).collect()} == want


def test_article_marks_do_not_decide(spark):
    """The given pages have the same texts without their article and main elements."""
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html")
    bare = pages.withColumn("html", F.regexp_replace("html", r"(?i)</?(article|main)\b[^>]*>", ""))
    texts = lambda df: {r.page_id: r.text for r in html_template.extract(df, keep=["page_id"]).collect()}
    assert texts(bare) == texts(pages)


def test_constant_part_of_an_article_goes(spark):
    """Within an article, too, a slot that never varies is template; an article that never varies stays."""
    part = "<div class='again'><p>Read these next</p></div>"
    pages = [("a.org", f"<body><article><h1>Title {i}</h1><p>Text {i}</p>{part}</article><div><p>Seen {i} times</p></div></body>") for i in range(5)]
    pages += [("b.org", f"<body><article><h1>Same</h1><p>Text</p></article><div><p>Seen {i} times</p></div></body>") for i in range(5)]
    got = extracted(spark, pages)
    assert got[0] == ["Title 0", "Text 0"] and got[5] == ["Same", "Text"]


def test_long_repeated_and_clashing_pages(spark):
    long = "<body><div>" + "".join(f"<p>Paragraph {i} of a long page</p>" for i in range(20_000)) + "</div></body>"
    rows = [(1, "http://l.org/1", long)] * 2 + [(2, "http://l.org/2", "<p>short</p>"), (None, None, None)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns({"TEXT": F.lit(1), "_host": F.lit("x"), "_Tokens": F.lit(2)})
    got = html_template.extract(frame)
    assert got.columns == ["page_id", "url", "html", "text"]
    texts = sorted((r.page_id or 0, r.text.count("\n\n") + 1 if r.text else 0) for r in got.collect())
    assert texts == [(0, 0), (1, 20_000), (1, 20_000), (2, 1)]
