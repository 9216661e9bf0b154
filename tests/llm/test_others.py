"""Sharding, URL rules, quality, rules, toxicity, extraction and the pipeline."""

from __future__ import annotations

import random
import re
import time
import zlib

import numpy as np
import pytest

import corpus_pipeline
from stockflow.llm import extract, quality, queries, rules, sharding, stats, toxicity, urls
from tests.llm.rows import documents, prose

SF = "/root/testdata/sf0.01"


def check_shards(got, rows, shards):
    assert len(got) == len(rows)
    sizes = [sum(r["size"] for r in got if r["shard"] == k) for k in range(shards)]
    for k in range(shards):
        slots = sorted(r["slot"] for r in got if r["shard"] == k)
        assert slots == list(range(len(slots)))
    most = max(r["size"] for r in got)
    assert max(sizes) - min(sizes) <= 2 * most + 0.01 * sum(sizes) / shards
    return sizes


def test_sharding_splits_a_hot_text_and_fills_slots(spark):
    hot = prose(1, 30)
    rows = [(i, hot if i % 3 == 0 else prose(i, i % 50)) for i in range(900)] + [(900, None)]
    got = sharding.shard_documents(documents(spark, rows), 7, rows_per_bin=20).collect()
    check_shards(got, rows, 7)
    texts = dict(rows)
    for r in got:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 8, zlib.crc32(data), "bytes", None)


def test_equal_texts_share_a_shard_where_they_can(spark):
    rows = [(i, prose(i % 200, 40)) for i in range(2000)]
    got = sharding.shard_documents(documents(spark, rows), 5, tolerance=0.05).collect()
    homes = {}
    for r in got:
        homes.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert all(len(h) == 1 for h in homes.values())


def test_fewer_documents_than_shards(spark):
    got = sharding.shard_documents(documents(spark, [(1, "a"), (2, "b")]), 24).collect()
    assert sorted(r["slot"] for r in got) in ([0, 0], [0, 1])


def plain_verdict(url, table, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in re.match("[^/?#]*", rest)[0])
    path = re.match("[^?#]*", rest[len(host) :])[0]
    fits = [
        (len(h + p), len(h), v, h + p) for v, h, p in table if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (host, path, max(fits)[3], max(fits)[2]) if fits else (host, path, None, default)


def test_url_rules_against_brute_force(spark):
    rng = random.Random(1)
    hosts = ["net", "a.net", "example.net", "b.example.net", "Example.COM", "x.example.com", "org", "n.org", "notnet", "a..net", ""]
    paths = ["", "/", "/en", "/en/", "/en/1", "/de/2?x=/fr/", "/fr/#a", "?q", "/EN/", "//"]
    found = [f"http{rng.choice(['', 's'])}://{h}{p}" for h in hosts for p in paths] + [None, "net/", "a://b://net/"]
    pages = spark.createDataFrame(list(enumerate(found)), "page_id long, url string")
    for table in (queries.URL_RULES, [*queries.URL_RULES, ("block", "example.net", "/e"), ("block", "a.net", ""), ("allow", "net", "/d")]):
        got = {r["page_id"]: tuple(r)[1:] for r in urls.judge(pages, urls.rule_table(spark, table)).collect()}
        assert got == {i: plain_verdict(u, table) for i, u in enumerate(found)}


def test_text_counts():
    text = "A b# c\nA b# c\n\n \nq é$ A b# c"
    got = stats.text_counts(np.frombuffer(text.encode(), np.uint8))
    words = text.split()
    threes = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    again = {j for i, t in enumerate(threes) if threes.count(t) > 1 for j in range(i, i + 3)}
    want = dict(n_words=11, word_chars=sum(map(len, words)), n_symbols=4, n_dup_lines=1, n_repeat_words=len(again), n_lines=3)
    assert {k: got[k] for k in want} == want


def labelled(spark):
    read = lambda t: spark.read.parquet(f"{SF}/{t}.parquet")
    return read("documents"), read("labels"), {r["doc_id"]: r for r in read("labels").collect()}


def test_quality_classifier_on_labels(spark):
    docs, labels, known = labelled(spark)
    got = [r for r in quality.classify(docs, labels).collect() if r["doc_id"] in known]
    right = np.mean([r["kept"] == bool(known[r["doc_id"]]["quality"]) for r in got])
    assert right >= 0.97


def test_sparse_sites_shrink_to_their_host(spark):
    rows = [(i, "big", "p", 0.0) for i in range(200)] + [(200, "big", "q", 0.0), (201, "new", "z", 0.0)]
    scored = spark.createDataFrame(rows, "doc_id long, host string, path string, evidence double")
    labels = spark.createDataFrame([(i, int(i % 10 > 0)) for i in range(200)] + [(200, 0), (201, 0)], "doc_id long, quality int")
    got = {}
    for r in quality.site_priors(scored, labels).collect():
        got.setdefault((r["host"], r["path"]), []).append(r["prior"])
    assert len(got["big", "p"]) == quality.FOLDS and all(abs(p - 0.9) < 0.02 for p in got["big", "p"])
    # The only document of its path, or of its host, has no say in its own prior.
    assert len(got["big", "q"]) == 1 and abs(got["big", "q"][0] - 0.9) < 0.03
    assert len(got["new", "z"]) == 1 and got["new", "z"][0] > 0.7


def test_a_document_does_not_raise_its_own_prior(spark):
    """Two documents of a small site: each has the prior that the other gives."""
    folds = dict(spark.createDataFrame([(i,) for i in range(40)], "doc_id long").select("doc_id", quality.fold()).collect())
    a = 0
    b = next(i for i in folds if folds[i] != folds[a])
    rows = [(i, "big", "p", 0.0) for i in range(100, 300)] + [(a, "s", "x", 6.0), (b, "s", "x", -6.0)]
    scored = spark.createDataFrame(rows, "doc_id long, host string, path string, evidence double")
    labels = spark.createDataFrame([(i, i % 2) for i in range(100, 300)], "doc_id long, quality int")
    got = {(r["host"], r["fold"]): r["prior"] for r in quality.site_priors(scored, labels).collect()}
    assert got["s", folds[a]] < got["s", folds[b]]


def test_quality_classifier_on_held_out_labels(spark):
    docs, labels, known = labelled(spark)
    held = {i for i in known if zlib.crc32(str(i).encode()) % 5 == 0}
    rest = labels.filter(~labels.doc_id.isin([int(i) for i in held]))
    got = [r for r in quality.classify(docs, rest).collect() if r["doc_id"] in held]
    assert np.mean([r["kept"] == bool(known[r["doc_id"]]["quality"]) for r in got]) >= 0.95


def test_threshold_against_brute_force(spark):
    rng = np.random.default_rng(3)
    for n in (2, 50, 400):
        score = np.round(rng.random(n), 2 if n < 400 else 6)
        good = rng.random(n) < 0.8
        good[:2] = [True, False]
        rows = spark.createDataFrame([(float(s), bool(g)) for s, g in zip(score, good)], "anomaly double, good boolean")
        for cost in (0.2, 1.0, 30.0):
            gains = {s: (score[~good] >= s).mean() - cost * (score[good] >= s).mean() for s in set(score.tolist())}
            got, best = rules.threshold(rows, cost), max(gains.values())
            assert (got == 2.0 and best <= 1e-12) or abs(gains[got] - best) < 1e-9
    assert rules.threshold(rows.filter("good"), 1.0) == 2.0 == rules.threshold(rows.limit(0), 1.0)


def test_rules_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    known = {r["doc_id"]: r["quality"] for r in labels.collect()}
    rest = labels.filter("crc32(cast(doc_id AS string)) % 5 <> 0")
    got = [r for r in rules.apply(docs, rest).collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["doc_id"] in known]
    good = [r["kept"] for r in got if known[r["doc_id"]] == 1 and not r["base_failed"]]
    assert np.mean(good) >= 0.97 and np.mean([r["kept"] for r in got if known[r["doc_id"]] == 0]) <= 0.15


def test_rules_keep_the_good_and_catch_outliers(spark):
    docs, labels, known = labelled(spark)
    got = [r for r in rules.apply(docs, labels).collect() if r["doc_id"] in known and not r["base_failed"]]
    good = [r["kept"] for r in got if known[r["doc_id"]]["quality"] == 1]
    bad = [r["kept"] for r in got if known[r["doc_id"]]["quality"] == 0]
    assert np.mean(good) >= 0.97 and np.mean(bad) <= 0.2


BLANK = re.compile("[ \t\n\r\x0b\x0c]+")


def plain_words(text):
    return [w for w in BLANK.split((text or "").lower()) if w]


def plain_counts(rows, folds):
    """word -> (contexts, texts by class and fold)."""
    want = {}
    for text, label, fold in rows:
        words = plain_words(text)
        for before, w in zip([" ", *words], words):
            want.setdefault(w, (set(), [0] * 2 * folds))[0].add(before.encode()[-1])
        for w in set(words):
            want[w][1][2 * fold + label] += 1
    return want


def test_word_counts_against_brute_force(spark, monkeypatch):
    """Handing on early, as after many words, changes no sum; a text counts a word once."""
    texts = [None, "", " \n", "aa ab  aa", "é aa abcdefghijkl", "abcdefghiXYZ \x1c b", *[prose(i, 40) for i in range(40)]]
    rows = [(t, i % 3 % 2, i % 4) for i, t in enumerate(texts)]
    want = plain_counts(rows, 4)
    docs = spark.createDataFrame(rows, "text string, label long, fold long")
    kinds = [f"{c}_{f}" for f in range(4) for c in ("ordinary", "toxic")]
    for most in (toxicity.GATHERED, 5):
        monkeypatch.setattr(toxicity, "GATHERED", most)
        monkeypatch.setattr(toxicity, "KEPT", most)
        got = {r["word"]: (r["contexts"], [r[k] for k in kinds]) for r in toxicity.word_counts(docs).collect()}
        named = {int(toxicity.words_of(w)[0].view(np.int64)[0]): w for w in want}
        assert {named[h]: v for h, v in got.items()} == {w: (len(c), n) for w, (c, n) in want.items()}


def plain_scores(spark, docs, labels):
    """doc_id -> score, from whole tables of words."""
    fold = dict(spark.createDataFrame([(i,) for i in labels], "i long").selectExpr("i", "pmod(xxhash64(i), 4)").collect())
    known = [i for i in labels if zlib.crc32(str(i).encode()) % 5]
    counts = plain_counts([(docs[i], labels[i], fold[i]) for i in known], 4)
    contexts = sum(len(c) for c, _ in counts.values())

    def ratios(folds):
        sides = []
        for c in (1, 0):
            n = {w: sum(k[2 * f + c] for f in folds) for w, (_, k) in counts.items()}
            n1, n2, n3, n4 = (sum(v == k for v in n.values()) for k in (1, 2, 3, 4))
            y = n1 / (n1 + 2 * n2)
            cut = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
            cut = [0.0, *[min(max(d, 0.0), k) for k, d in enumerate(cut, 1)]]
            total = sum(n.values())
            sides.append((n, cut, total, sum(cut[min(v, 3)] for v in n.values()) / total))
        unseen = np.log(sides[0][3]) - np.log(sides[1][3])
        out = {}
        for w, (before, _) in counts.items():
            (t, dt, tt, wt), (o, do, to, wo) = sides
            back = len(before) / contexts
            own = (t[w] - dt[min(t[w], 3)]) / tt, (o[w] - do[min(o[w], 3)]) / to
            seen = np.log(own[0] + wt * back) - np.log(own[1] + wo * back)
            out[w] = seen if t[w] + o[w] else unseen
        return lambda w: out.get(w, unseen)

    def measures(text, ratio):
        values = [ratio(w) for w in plain_words(text)]
        n = len(values)
        if not n:
            return (0.0,) * 7
        size = min(3, n)
        sums = [sum(values[i : i + size]) for i in range(n - size + 1)]
        best = max(range(len(sums)), key=lambda i: (sums[i], -i))
        apart = [s for i, s in enumerate(sums) if abs(i - best) >= size]
        each = [ratio(w) for w in set(plain_words(text))]
        over = [np.log1p(sum(max(v - b, 0) for v in each)) for b in (2.5, 3.5, 4.5)]
        return sum(values) / n, sums[best] / 3, max(apart, default=0.0) / 3, *over, np.log1p(n)

    crossed = [ratios([g for g in range(4) if g != f]) for f in range(4)]
    rows = np.array([measures(docs[i], crossed[fold[i]]) for i in known])
    model = toxicity.fit_decision(rows, np.array([labels[i] > 0 for i in known]))
    final = ratios([0, 1, 2, 3])
    out = {}
    for i, text in docs.items():
        x = np.clip((np.array(measures(text, final)) - model.mean) / model.scale, -8, 8)
        out[i] = 1 / (1 + np.exp(-(model.weights[0] + x @ model.weights[1:])))
    return out


@pytest.mark.parametrize("slots", [1 << 20, 32])
def test_toxicity_scores_against_brute_force(spark, slots):
    texts = [prose(i, 5 + i % 60) + (" vile scum" * (i % 2) + f" rare{i // 9}" if i % 3 == 0 else " kind") for i in range(160)]
    docs = dict(enumerate([*texts, None, "", " ", "one", "new words only here", "vile", "x" * 1_000_000 + " scum"]))
    labels = {i: int(i % 3 == 0) for i in range(120)}
    table = spark.createDataFrame(list(labels.items()), "doc_id long, toxic int")
    frame = documents(spark, list(docs.items())).withColumnsRenamed({"lang": "label", "source": "model", "n_chars": "score"})
    got = {r["doc_id"]: r["score"] for r in toxicity.score(frame, table, slots=slots).collect()}
    want = plain_scores(spark, docs, labels)
    assert set(got) == set(want)
    assert max(abs(got[i] - want[i]) for i in want) < 1e-3


def test_a_word_in_three_toxic_texts_moves_the_score(spark):
    texts = [prose(i, 40) + (f" rare{i % 40}" if i < 120 else f" other{i}") for i in range(400)]
    docs = {i: t for i, t in enumerate(texts)} | {1000: prose(7, 40) + " rare5", 1001: prose(7, 40) + " neverseen"}
    labels = {i: int(i < 120) for i in range(400)}
    table = spark.createDataFrame(list(labels.items()), "doc_id long, toxic int")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(documents(spark, list(docs.items())), table).collect()}
    assert got[1000] > got[1001] + 0.005, (got[1000], got[1001])


def test_marks_keep_every_known_id(spark):
    known = spark.createDataFrame([(i * 7,) for i in range(300)], "doc_id long")
    docs = spark.createDataFrame([(i,) for i in range(3000)] + [(None,)], "doc_id long")
    got = {r["doc_id"] for r in toxicity._marked(docs, known, marks=64).collect()}
    assert {i * 7 for i in range(300)} <= got and len(got) < 900
    assert not toxicity._marked(docs, known.limit(0)).count()


def test_toxicity_on_held_out_rows(spark):
    read = lambda t: spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet")
    known = {r["doc_id"]: r["toxic"] for r in read("labels").collect()}
    got = toxicity.score(read("documents"), read("labels")).collect()
    assert all(0 <= r["score"] <= 1 and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    held = [(r["score"], known[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in known]
    toxic, other = (np.array([s for s, k in held if k == kind]) for kind in (1, 0))
    assert np.mean([(toxic > s).mean() for s in other]) >= 0.95
    assert (toxic >= 0.5).mean() >= 0.9 and (other >= 0.5).mean() <= 0.1


@pytest.mark.parametrize("slots", [16, 1 << 10])
def test_slots_change_no_toxicity_score(spark, slots):
    """Grams without a slot keep their own ratio and unseen ones their backoff."""
    texts = [prose(i, 30 + i % 50) + (" vile scum qzx" if i % 3 == 0 else " kind sum") for i in range(150)] + [None, "", "qzy scumming", "new words"]
    docs = documents(spark, list(enumerate(texts)))
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(120)], "doc_id long, toxic int")
    want, got = ({r["doc_id"]: r["score"] for r in toxicity.score(docs, labels, slots=n).collect()} for n in (1 << 21, slots))
    assert set(want) == set(got) and len(set(want.values())) > 50
    assert all(abs(want[i] - got[i]) < 1e-9 for i in want)


def test_toxicity_reads_whole_words(spark):
    """Words that differ after many characters have scores of their own."""
    stem = "donaudampfschiff"
    texts = [f"{prose(i, 20)} {stem}{'hass' if i % 2 else 'fahrt'}" for i in range(120)]
    texts += [f"river {stem}hass", f"river {stem}fahrt"]
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(documents(spark, list(enumerate(texts))), labels).collect()}
    assert got[120] > 0.5 > got[121]


@pytest.fixture(scope="module")
def model():
    return extract.train([])


def test_marginals_are_exact(model):
    """Sum-product against the sum over all states of a small page."""
    nodes = extract.in_order(extract.parse("<div class=content><p>one two</p><nav><a>x</a></nav></div>"))
    got = extract.marginals(nodes, model)
    measure = extract._measure(nodes)
    index = {id(n): i for i, n in enumerate(nodes)}
    total, inside = 0.0, np.zeros(len(nodes))
    for bits in range(2 ** len(nodes)):
        state = [bits >> i & 1 for i in range(len(nodes))]
        log = model.root * state[0]
        for i, n in enumerate(nodes):
            log += state[i] * sum(model.unary.get(f, 0.0) for f in extract.features(n, measure[id(n)]))
            if n.parent is not None:
                default = np.log(np.array([[0.95, 0.05], [0.05, 0.95]]))
                log += model.edge.get(extract._edge_kind(n), default)[state[index[id(n.parent)]], state[i]]
        total += np.exp(log)
        inside += np.exp(log) * np.array(state)
    assert np.allclose(got, inside / total)


def test_extraction_of_unseen_layouts(model):
    pages = {
        "<body><div id=cookie-banner>We use cookies</div><div class='post-content'><h1>T&amp;t</h1><p>One  two<br>three <i>x</i>y."
        "<div class=ad-slot>Buy</div><ul><li>a<li>b</ul></div><div id=comments><p>Great read</p></div><form><p>Sign</form></body>":
        "T&t\nOne two three xy.\na\nb",
        "<nav>m</nav><main><p>Main text is this one here.</p><aside>no</aside></main><footer>f</footer>": "Main text is this one here.",
        "<article><h1>H</h1><p>a<p>b<script>1</script><!-- c --></article>": "H\na\nb",
    }
    for html, want in pages.items():
        assert extract.main_text(html, model) == want


BODY = "<p>The river had risen overnight and the lower fields lay under water, brown and still.</p>"


@pytest.mark.parametrize(
    "page",
    [
        "<html><head><title>t</title></head><body><h1>A title</h1>{0}</body></html>",
        "<html><body>{0}</body></html>",
        "<html><body><div><div>{0}</div></div></body></html>",
        "<html><body><nav><a href=/>home</a></nav><div><div><div>{0}</div></div></div><footer>(c) all of it</footer></body></html>",
        "<html><body><nav><a href=/>home</a></nav>{0}<aside><p>Most read today</p></aside><footer>(c) all of it</footer></body></html>",
        "{0}",
    ],
)
def test_main_text_that_no_section_holds(model, page):
    paragraphs = [f"{i} {BODY[3:-4]}" for i in range(8)]
    want = "\n".join([*(["A title"] if "<h1>" in page else []), *paragraphs])
    assert extract.main_text(page.format("".join(f"<p>{p}</p>" for p in paragraphs)), model) == want


def test_deep_pages_take_linear_time(model):
    for html in ("<center>" * 50_000 + "x", "<div></x>" * 50_000, "<p><b></i>" * 50_000, "<ul><li>" * 25_000 + "x", "<p><center>" * 25_000):
        began = time.process_time()
        extract.parse(html)
        assert time.process_time() - began < 2


def test_extraction_of_the_given_pages(spark):
    import html as entities

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = extract.extract(spark.read.parquet(f"{SF}/pages.parquet")).collect()
    for r in got:
        article = re.search("<article>(.*)</article>", pages[r["page_id"]], re.S)[1].replace("<br>", " ")
        blocks = [entities.unescape(re.sub("<[^>]*>", "", b)) for b in re.split("</?(?:h1|p)>", article)]
        want = "\n".join(" ".join(b.split()) for b in blocks if b.split())
        assert (r["text"], r["n_chars"]) == (want, len(want))


def test_pipeline_runs_stage_by_stage(spark):
    """The whole run equals the stages one by one, and packs all documents that the stages keep."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = stage(spark, docs, SF).cache()
        assert 0 < docs.count() <= before
    kept = {r["doc_id"] for r in docs.select("doc_id").collect()}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in got} == kept
    assert len({(r["doc_id"], r["start"]) for r in got}) == len(got)
