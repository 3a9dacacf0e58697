"""Pages, URLs, embeddings and token shards: against plain Python on small tables."""

import glob
import html
import json
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import embed_dup, html_extract, token_output, url_filter
from shelfwise.llm.common import Scratch, packed, read, small_batches
from shelfwise.llm.html_blocks import blocks
from shelfwise.llm.html_pages import labelled_pages

# --- pages


@pytest.fixture(scope="module")
def field():
    return html_extract.trained()


def test_blocks_of_odd_markup():
    text = lambda page: [b.text for b in blocks(page)]
    assert text(None) == text("") == text("<p> \n </p>") == []
    assert text("<p><b>One &amp; two<br>x<p>Thr<i>ee</i><script>'</p>'</script> four</p>tail &nbsp; end") == ["One & two x", "Three four", "tail end"]
    assert text("<title>t</title><style>p{}</style><!-- c <p>no</p> --><ul><li>a<li>b</ul>a &lt; b &copy; &amp c") == ["a", "b", "a < b © & c"]
    assert text('<a href="x>y">z</a> < 3 <b') == ["z < 3 <b"]
    assert text("<script>never closed <p>x</p>") == [] and text("<!-- never closed <p>x</p>") == []
    assert [b.path[-1] for b in blocks("<div class='A-b' id=c><p hidden>x</p></div>")] == ["p unseen"]
    assert len(text("<p>" + "w " * 200_000 + "</p>" * 3 + "<div>" * 2000 + "deep")) == 2


def test_blocks_after_elements_that_are_never_closed():
    text = lambda page: [b.text for b in blocks(page)]
    assert text("<html><head><title>t</title><meta charset=x><body><p>a<p>b") == ["a", "b"]
    assert text("<head><title>t</title><link href=x><p>a</p><div>b</div>") == ["a", "b"]
    assert text("<head><title>t</title>plain<p>b") == ["plain", "b"]
    assert text("<head><title>never closed<body><p>a</p>") == text("<head><title>never closed<p>a</p>") == ["a"]
    assert text("<head><title>a <b>c</b> <p>d</title><noscript><img src=x></noscript></head><p>b") == ["b"]
    for name in "svg iframe object canvas audio video textarea math noembed".split():
        assert text(f"<div><p>a</p><{name} x=y><p>b</p><p>c</p></div>d") == ["a", "b", "c", "d"], name
        assert text(f"<div><p>a</p><{name}>hidden</{name}><p>b</p></div>") == ["a", "b"], name
    assert text("<div><svg><path/><p>a</p><svg><text>no</text></svg><p>b</p>") == ["a", "b"]
    assert text("<p>a <svg/>b</p><svg><text>no</text></svg>") == ["a", "b"]


def test_blocks_of_quotes_and_empty_comments():
    text = lambda page: [b.text for b in blocks(page)]
    assert text("<p title=it's>First it's par.</p><p>Second it's par.</p>") == ["First it's par.", "Second it's par."]
    assert text("""<p title=5"x>a</p><p class = 'b>c' id="d'>e">f "g"</p>""") == ["a", 'f "g"']
    assert text("<p>a</p><!--><p>b</p><!-- c --><p>d</p><!---><p>e</p><!-- f -->") == ["a", "b", "d", "e"]


def test_field_on_pages_it_has_not_seen(field):
    pages = labelled_pages(200, 77)
    right = [(a, b) for page, labels in pages for a, b in zip(field.labels(blocks(page)), labels, strict=True)]
    assert sum(a == b for a, b in right) / len(right) > 0.99


def test_articles_of_the_pages_table(spark, field):
    def article(page):
        inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
        inner = re.sub(r"</?b>|<br>", " ", inner)
        return "\n".join(x for x in (" ".join(html.unescape(y).split()) for y in re.split(r"</?(?:p|h1)>", inner)) if x)

    pages = read(small_batches(spark), "/root/testdata/sf0.01", "pages").withColumn("main_text", F.lit("mine"))
    rows = html_extract.extract(pages, field).collect()
    assert len(rows) == pages.count() and all(r["main_text"] == article(r["html"]) for r in rows)
    odd = spark.createDataFrame([(1, None), (2, ""), (2, "<p>"), (None, "<nav>a</nav>")], "page_id long, html string")
    assert [r["main_text"] for r in html_extract.extract(odd, field).collect()] == [""] * 4
    assert html_extract.extract(odd.limit(0), field).count() == 0


def test_field_prefers_the_true_labelling():
    """Viterbi against all labellings, and the gradient's fixed point against counts."""
    page = blocks("<nav><a>x</a></nav><div><p>One two three.</p><p>Four.</p></div><footer>f</footer>")
    f = html_extract.Field.fit([(page, [0, 1, 1, 0])], steps=80)
    own = [sum(f.weights.get(x, 0) for x in html_extract.path_features(b.path) + html_extract.text_features(b)) for b in page]

    def score(labels):
        total = (own[0] + f.start) * labels[0]
        for i in range(1, len(page)):
            total += f.moves[int(page[i].parent == page[i - 1].parent)][labels[i - 1]][labels[i]] + own[i] * labels[i]
        return total

    every = [[(n >> k) & 1 for k in range(4)] for n in range(16)]
    assert f.labels(page) == max(every, key=score) == [0, 1, 1, 0]
    assert f.labels([]) == [] and html_extract.Field.fit([]).labels(page) in every


# --- URLs


URLS = [
    None, "", "no scheme/here", "http://", "HTTP://Example.NET", "http://example.net/en/1?x=http://b.net/de/", "https://a.b.example.com/de/",
    "https://example.com/den/", "ftp://x.org/fr/#/a", "http://org/fr/", "http://notnet/", "http://a.net?/", "http://A.NET/É?q", "x://y://z/",
    "http://u.example.net/en/", "http://casino-win.example.com/en/" + "a" * 50_000,
]


def plain_rule(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host = re.sub("[A-Z]", lambda c: c[0].lower(), m[1]) if m else ""
    path = m[2] if m else ""
    fits = [
        (len(rule), rule, verdict)
        for verdict, rule in url_filter.RULES
        if (host == rule.split("/")[0] or host.endswith("." + rule.split("/")[0])) and path.startswith(rule[rule.index("/") :])
    ]
    return host, path, max(fits)[1:] if fits else (None, None)


def test_rules_and_odd_urls(spark):
    rows = [(i, url, "mine", "mine", 3) for i, url in enumerate(URLS)] + [(0, URLS[0], "mine", "mine", 3)]
    df = spark.createDataFrame(rows, "page_id long, url string, score string, host string, depth int")
    out = url_filter.judge(df, Scratch(spark, "t"), model=url_filter.UrlModel()).collect()
    assert len(out) == len(rows) and all(r["depth"] == 3 for r in out)
    for r in out:
        host, path, (rule, verdict) = plain_rule(r["url"])
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict or "allow"), r["url"]
    assert url_filter.judge(df.limit(0), Scratch(spark, "t")).count() == 0


def plain_features(url, hosts):
    text = url or ""
    host, path, _ = plain_rule(url)
    parts, n = host.split("."), max(1, len(text))
    query = re.search(r"\?([^#]*)", text)
    counts = Counter(host).values()
    suffix = ".".join(parts[-2:])
    return {
        "url_chars": len(text), "host_chars": len(host), "path_chars": len(path), "depth": len(re.findall("/[^/]", path)),
        "labels": len(parts), "hyphens": host.count("-"), "host_digits": len(re.findall("[0-9]", host)) / max(1, len(host)),
        "digits": len(re.findall("[0-9]", text)) / n,
        "entropy": -sum(c / len(host) * math.log2(c / len(host)) for c in counts) if host else 0.0,
        "parameters": len(re.findall("[^&]+", query[1])) if query else 0, "fragment": "#" in text,
        "secure": text.lower().startswith("https:"), "vowels": len(re.findall("[aeiou]", host)) / max(1, len(host)),
        "longest_label": max(map(len, parts)),
        "suffix_hosts": math.floor(math.log2(1 + sum(".".join(h.split(".")[-2:]) == suffix for h in hosts))),
    }


def test_features_like_plain_python(spark):
    urls = [*URLS, "https://a-b.c9.example.org/x//y/?a=1&&b=2#f", "http://a-b.c9.example.org/", "http://u.example.org?q#&x"]
    df = packed(spark.createDataFrame([(u,) for u in urls], "url string"), url=F.col("url"))
    hosts = {plain_rule(u)[0] for u in urls}
    for r in url_filter.features(df, Scratch(spark, "t")).collect():
        want = plain_features(r["url"], hosts)
        assert set(want) == set(url_filter.LEXICAL)
        assert {k: float(r[k]) for k in want} == pytest.approx({k: float(v) for k, v in want.items()}), r["url"]


def test_entropy_feature(spark):
    texts = ["", "a", "abab", "casino-win.example.com", "éé🙂a"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", url_filter.entropy(F.col("t")).alias("e"))
    for r in df.collect():
        counts = Counter(r["t"]).values()
        assert abs(r["e"] + sum(c / len(r["t"]) * math.log2(c / len(r["t"])) for c in counts)) < 1e-9


@pytest.mark.parametrize("word", ["casino", "bets", "spam", "track"])
def test_url_model_finds_hosts_it_has_not_seen(spark, word):
    """All hosts with a marked word are left out of training, and the word is not a mark: the trees block most of them."""
    pages = read(spark, "/root/testdata/sf0.1", "pages").select("page_id", "url")
    marked = [m for m in url_filter.MARKED if m not in (word, *(["ads", "ad"] if word == "track" else ["bet"] if word == "bets" else []))]
    rows = url_filter.features(packed(pages, url=F.col("url")), Scratch(spark, "t"))
    out = F.col("host").contains(word)
    label = url_filter.weak_label(F.col("host"), url_filter.rule_of(F.col("host"), F.col("path"))[1], marked)
    model = url_filter.UrlModel.fit(rows.where(~out).withColumn("label", label), Scratch(spark, "t"))
    scored = model.score(rows).select(out.alias("held_out"), F.col("host").rlike("[-]").alias("odd"), (F.col("score") >= 0.5).alias("block")).toPandas()
    unseen, plain = scored[scored["held_out"]], scored[~scored["odd"]]
    assert len(unseen) >= 18 and unseen["block"].mean() >= 0.8 and plain["block"].mean() <= 0.02


def test_url_model_without_both_classes(spark):
    pages = url_filter.features(packed(read(spark, "/root/testdata/sf0.001", "pages"), url=F.col("url")), Scratch(spark, "t"))
    for label in (F.lit(None).cast("double"), F.lit(1.0)):
        model = url_filter.UrlModel.fit(pages.withColumn("label", label), Scratch(spark, "t"))
        assert model.score(pages.limit(3)).select("score").distinct().collect()[0][0] == 0.0


# --- embeddings


def test_bounds_hold():
    rng = np.random.default_rng(1)
    for dim in (1, 2, 7, 64, 1500):
        u = embed_dup.unit(rng.normal(size=(60, dim)) * rng.choice([1e-200, 1.0, 1e200], size=(60, 1)))
        u = np.concatenate([u, embed_dup.unit(u + rng.normal(scale=0.2 / math.sqrt(dim), size=u.shape))])
        q, scale, kept, error = embed_dup.quantised(u)
        true = u @ u.T
        near = (q.astype(float) @ q.astype(float).T) * scale[:, None] * scale[None, :]
        assert (np.abs(true - near) <= kept[:, None] * error[None, :] + error[:, None] + embed_dup.SLACK).all()
        every = np.arange(len(u))
        assert (embed_dup.near_pairs(u, every, every, 0.98) == (np.einsum("ik,jk->ij", u, u) >= 0.98)).mean() == 1.0


@pytest.mark.parametrize("chunk", [1024, 7])
def test_links_like_all_pairs(spark, chunk):
    rng = np.random.default_rng(4)
    rows = []
    for c in range(12):
        base = rng.normal(size=16)
        for _ in range(rng.integers(1, 9)):
            rows.append((len(rows), (base + rng.normal(scale=0.15 * rng.random(), size=16)).astype(float).tolist(), int(c % 3)))
    rows += [(500 + i, [2 * x for x in rows[i][1]], rows[i][2]) for i in range(5)]  # other lengths, same directions
    rows += [(600 + i, rows[7][1], rows[7][2]) for i in range(6)]
    rows += [(700, None, 1), (701, [], 1), (702, [0.0] * 16, 1), (703, [1.0, None] * 8, 1), (704, [math.nan] * 16, 1)]
    rows += [(705, [math.inf] * 16, 1), (706, rows[0][1], None), (707, rows[0][1][:8], rows[0][2]), (None, rows[0][1], rows[0][2])]
    rows += [(708, [-0.0, 1.0], 1), (709, [0.0, 1.0], 1), rows[3]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("kept", F.lit("mine"))
    small = df.withColumn("id", F.lit("mine")).withColumn("packed", F.lit(1))
    out = embed_dup.link_vectors(small, Scratch(small_batches(spark), "t"), chunk=chunk).collect()

    def fine(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    unit = [np.array(v) / np.linalg.norm(v) if fine(v) and label is not None else None for _, v, label in rows]
    n = len(rows)
    link = [
        [
            j != i and unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2]
            and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.98
            for j in range(n)
        ]
        for i in range(n)
    ]
    label = list(range(n))
    for _ in range(n):
        label = [min([label[i], *(label[j] for j in range(n) if link[i][j])]) for i in range(n)]
    want = Counter()
    for i in range(n):
        ids = [rows[j][0] for j in range(n) if label[j] == label[i] and rows[j][0] is not None]
        least = min(ids, default=None)
        want[(rows[i][0], sum(link[i]), least, rows[i][0] == least)] += 1
    assert Counter((r["id"], r["n_links"], r["component_id"], r["kept"]) for r in out) == want
    assert embed_dup.link_vectors(df.limit(0), Scratch(spark, "t")).count() == 0


# --- token shards


def test_feistel_is_a_permutation():
    for n in [*range(1, 70), 255, 256, 257, 1000, 4099]:
        slots = token_output.feistel(np.arange(n), n)
        assert sorted(slots.tolist()) == list(range(n))
    assert (token_output.feistel(np.arange(1000), 1000, 1) != token_output.feistel(np.arange(1000), 1000, 2)).any()
    assert token_output.feistel(np.array([10**12 - 1]), 10**12)[0] < 10**12


def test_shards_round_trip(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(["alpha", "béta", "<|endoftext|>", "x9", "\n"]) for _ in range(rng.randrange(120)))) for i in range(90)]
    rows += [(None, None), (7, ""), (8, "z" * 30_000), (8, "z" * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("slot", F.lit("mine")).repartition(4)
    spark = small_batches(spark)
    scratch = Scratch(spark, "t")
    listed = token_output.materialise(docs, scratch, length=64, shard=40).collect()
    root = scratch.root.removeprefix("file:")
    (name,) = glob.glob(f"{root}/layout/*.json")
    layout = json.load(open(name))
    records = list(token_output.read_from(root, 0, layout))
    assert layout["sequences"] == len(records) == len(listed)
    assert sorted(r["slot"] for r in listed) == list(range(len(listed)))
    assert all(r["slot"] // 40 == r["shard"] and r["byte_offset"] == r["slot"] % 40 * 129 for r in listed)
    for start in (0, 1, 39, 40, len(records) - 1, len(records)):
        assert [x.tolist() for x in token_output.read_from(root, start, layout)] == [x.tolist() for x in records[start:]]
    # Back in the order of the stream, the records give the texts, partition by partition.
    encode = token_output.encoder(token_output.VOCABULARY)
    found = token_output.sequences(docs, Scratch(spark, "t"), length=64, shard=40).table
    texts, ids = Counter(), Counter()
    by_part = {}
    for r in found.select("part", "local", "slot", "n_tokens", "doc_ids").collect():
        by_part.setdefault(r["part"], []).append((r["local"], r["slot"], r["n_tokens"], r["doc_ids"]))
    for part in by_part.values():
        stream, seen = [], []
        for _, slot, n, docs_in in sorted(part, key=lambda x: x[0]):
            stream += records[slot].tolist()[:n]
            seen += docs_in
        assert stream[-1] == token_output.END
        piece = []
        for token in stream:
            if token == token_output.END:
                texts[encode.decode(piece)] += 1
                piece = []
            else:
                piece.append(token)
        ids.update(seen)
    assert texts == Counter(t or "" for _, t in rows) and set(ids) == {i for i, _ in rows}
    empty = Scratch(spark, "t")
    assert token_output.materialise(docs.limit(0), empty).count() == 0
