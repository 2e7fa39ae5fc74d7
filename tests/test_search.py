"""Searches against a plain evaluation of the same rules on a few pages."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import pagequill as pq
from pagequill import sizing
from pagequill.operators import ranking as rk, titles as tl, toplist, words as wd
from pagequill.plans import prune
from pagequill.sources import index_store
from pagequill.sources.tables import store_by_id, store_by_title

from .conftest import rows

PAGE_SCHEMA = "id long, title string, redirect_title string, text string, content string"
REQUEST_SCHEMA = "request_id long, msg string"


def norm(title):
    return re.sub(r"[^\x00-\x7f]", " ", title).lower()


class Plain:
    """The rules of a search, one page and one word at a time."""

    def __init__(self, pages):
        self.tf, self.n_words, self.max_tf = defaultdict(Counter), Counter(), Counter()
        self.redirect, titles = {}, defaultdict(list)
        for page, title, redirect, _, content in pages:
            counts = Counter(re.findall("[a-z]+", content.lower()))
            self.n_words[page] += sum(counts.values())
            self.max_tf[page] += max(counts.values(), default=0)
            for word, n in counts.items():
                self.tf[word][page] += n
            if redirect:
                self.redirect[page] = norm(redirect)
            titles[norm(title)].append(page)
        self.titles = {t: sorted(set(ids), key=str) for t, ids in titles.items()}

    def search(self, msg, honour=False):
        limit, _, words = msg.strip().partition(" ")
        limit = int(limit)
        k, parts = abs(limit), self.n_words if limit < 0 or not honour else self.max_tf
        times, log = Counter(), defaultdict(float)
        for word in [w for w in words.lower().split(" ") if w]:
            for page, tf in self.tf.get(word, {}).items():
                df = len(self.tf[word])
                times[page] += 1
                log[page] += math.log(tf) + (math.inf if df == 1 else -math.log(math.log(df)))
        order = sorted(times, key=lambda p: (-times[p], -round(log[p] - math.log(parts[p]), 9), p))
        out = []
        for page in order:
            if self.n_words[page] < 100:
                found = self.titles.get(self.redirect.get(page, "\0"))
                if not found:
                    continue
                page = found[0]
            if page not in out:
                out.append(page)
        out = out[:k]
        if not out:
            return []
        prefix = norm(words)
        hits = {p for t, ids in self.titles.items() if t.startswith(prefix) for p in ids}
        return (out + [p for p in sorted(hits, key=str)[:k] if p not in out])[:k]


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = ["the", "heat", "of", "sun", "page", "list", "x", "zeta"] + [f"w{c}" for c in "abcdefgh"]
    pages = []
    for page in rng.sample(range(1, 400), 60):
        title = f"{rng.choice(['Page', 'List', 'Été'])} {rng.choice('abc')}{rng.randrange(4)}"
        redirect = f"{rng.choice(['page', 'LIST', 'Nope'])} {rng.choice('abc')}{rng.randrange(4)}"
        short = rng.random() < 0.5
        n = rng.randrange(1, 30) if short else rng.randrange(95, 160)
        content = " ".join(rng.choices(vocabulary, weights=[9, 5, 4, 3, 2, 2, 1, 0.02] + [1] * 8, k=n))
        pages.append((page, title, redirect if short and rng.random() < 0.6 else "", content, content))
    return pages


MESSAGES = [
    "10 the heat tion", "-5 the the", "3 foo-bar", "5 nosuchwordxyz", "10 Page a", "2   spaced   the",
    "40 list", "-40 list", "7 zeta the", "1000 of sun", "0 the", "1500 the of", "4 PAGE", "10 the heat tion",
    "3 the heat tion", "25 page b1 Heat HEAT of",
]


@pytest.fixture(scope="module")
def corpora(spark, tmp_path_factory):
    out = []
    for seed in (1, 2):
        pages = corpus(seed)
        df = spark.createDataFrame(pages, PAGE_SCHEMA)
        out.append((Plain(pages), pq.write_index(df, str(tmp_path_factory.mktemp("index"))), df))
    return out


def answers(results, messages):
    got = defaultdict(list)
    for r in sorted(results.collect(), key=lambda r: (r["request_id"], r["rank"])):
        assert r["rank"] == len(got[r["request_id"]]) + 1
        got[r["request_id"]].append(r["id"])
    return [got[i] for i in range(len(messages))]


@pytest.mark.parametrize("honour", [False, True])
def test_batch_against_plain_rules(spark, corpora, honour):
    requests = spark.createDataFrame(list(enumerate(MESSAGES)), REQUEST_SCHEMA)
    for plain, index, _ in corpora:
        expected = [plain.search(m, honour) for m in MESSAGES]
        assert answers(pq.search_batch(requests, index, honour), MESSAGES) == expected
        assert any(expected) and not all(expected)


def test_single_search_equals_batch(corpora):
    plain, index, _ = corpora[0]
    for msg in MESSAGES[:6]:
        found = pq.search(msg, index).collect()
        assert [r["id"] for r in found] == plain.search(msg)


def test_large_batches_take_the_other_joins(spark, corpora, monkeypatch):
    """Beyond the limits nothing is collected, filtered by key or broadcast."""
    plain, index, _ = corpora[0]
    requests = spark.createDataFrame(list(enumerate(MESSAGES)), REQUEST_SCHEMA)
    monkeypatch.setattr(sizing, "FILTER_ROWS", 2)
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 2)
    monkeypatch.setattr(sizing.settle, "__defaults__", (2,))
    monkeypatch.setattr(sizing.is_small, "__defaults__", (2, 10))
    monkeypatch.setattr(prune, "LOCAL_ROWS", 2)
    monkeypatch.setattr(sizing.held, "__defaults__", (2,))
    monkeypatch.setattr(toplist, "CUT_BEFORE_SHUFFLE", 3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        results = pq.search_batch(requests, index)
        assert "BroadcastHashJoin" not in results._jdf.queryExecution().toString()
        assert answers(results, MESSAGES) == [plain.search(m) for m in MESSAGES]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def long_and_short(seed, n=400):
    """Pages of 100 to 4,000 words in which frequent words are spread unevenly."""
    rng = random.Random(seed)
    pages = []
    for page in range(n):
        words = rng.choices(["the", "of", "sun", "heat"], weights=[rng.randrange(1, 9) for _ in range(4)], k=int(100 * 40 ** rng.random()))
        words += rng.choices(["rare", "dim", "zeta"], k=1) if rng.random() < 0.05 else []
        pages.append((page, f"Page {page}", "", " ".join(words), " ".join(words)))
    return pages


def lookups_read(monkeypatch):
    """Postings that the lookups of later searches read, one number per round."""
    read = []
    places = prune.scored_places

    def counting(index, wanted, *rest):
        read.append(wanted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
        return places(index, wanted, *rest)

    monkeypatch.setattr(prune, "scored_places", counting)
    return read


@pytest.mark.parametrize("honour", [False, True])
def test_bounds_leave_bands_of_frequent_words_out(spark, tmp_path, monkeypatch, honour):
    """Exact at default settings, although most postings of the words are not read."""
    pages = long_and_short(9)
    plain, index = Plain(pages), pq.write_index(spark.createDataFrame(pages, PAGE_SCHEMA), str(tmp_path / "index"))
    assert index.bounds.select("band").distinct().count() >= 5
    read = lookups_read(monkeypatch)
    for msg in ("5 the", "-5 the of", "3 the of sun heat", "5 rare the", "-4 the the heat", "300 sun", "2 zeta dim"):
        read.clear()
        words = set(msg.split()[1:])
        total = sum(len(plain.tf[w]) for w in words)
        assert [r["id"] for r in pq.search(msg, index, honour).collect()] == plain.search(msg, honour), msg
        if not honour and msg in ("-5 the of", "3 the of sun heat"):
            assert sum(read) < total / 2, (msg, read, total)


def test_a_second_round_reads_what_the_bar_leaves_open(spark, corpora, monkeypatch):
    """With a first round of one band, the others are needed wherever they could still have results."""
    monkeypatch.setattr(prune, "FIRST_PAGES", 0.01)
    messages = MESSAGES + ["1 the heat", "2 of page sun the", "3 wa wb wc the the", "2 x the", "1 zeta the"]
    requests = spark.createDataFrame(list(enumerate(messages)), REQUEST_SCHEMA)
    for plain, index, _ in corpora:
        read = lookups_read(monkeypatch)
        assert answers(pq.search_batch(requests, index), messages) == [plain.search(m) for m in messages]
        assert len(read) == 2 and min(read) > 0


def test_no_match_is_shuffled(spark, corpora):
    """Between the postings and the cut to k per request and bucket there is no exchange."""
    _, index, _ = corpora[0]
    terms = spark.createDataFrame([(r, 1, w, 1) for r in (0, 1) for w in ("the", "heat")], "request_id long, strategy int, word string, repeats long")
    wanted, _ = sizing.held(prune.band_lookups(terms, index.bounds, index.word_buckets), "lookups")
    plan = prune.scored_places(index, wanted, True, ["heat", "the"], 10, False)._jdf.queryExecution().executedPlan().toString()
    nodes = [re.sub(r"^[ :+*()\d-]*", "", line) for line in plan.split("\n")]
    scan = next(i for i, n in enumerate(nodes) if n.startswith("FileScan parquet"))
    exchanges = [i for i, n in enumerate(nodes) if n.startswith("Exchange")]
    cut = next(i for i, n in enumerate(nodes) if n.startswith("WindowGroupLimit") and "Partial" in n)
    assert exchanges and all(i < cut < scan for i in exchanges), plan
    assert re.search(r"PartitionFilters: \[[^]]*word_bucket", plan) and "SelectedBucketsCount" in plan


def test_many_words_read_their_buckets_only(spark, tmp_path):
    pages = [(i, "", "", "", " ".join(f"w{chr(97 + j // 26)}{chr(97 + j % 26)}{chr(97 + i % 26)}" for j in range(120))) for i in range(60)]
    index = pq.write_index(spark.createDataFrame(pages, PAGE_SCHEMA), str(tmp_path / "index"), page_buckets=3, word_buckets=16)
    words = [r["word"] for r in index.vocabulary.where(F.pmod(F.xxhash64("word"), F.lit(16)).isin(2, 5)).collect()]
    assert len(words) > 200
    terms = spark.createDataFrame([(0, 1, w, 1) for w in words], "request_id long, strategy int, word string, repeats long")
    wanted, _ = sizing.held(prune.band_lookups(terms, index.bounds, index.word_buckets), "lookups", 10)
    found = prune.scored_places(index, wanted, True, None, 10, False)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*word_bucket#\d+ IN \(2,5\)", plan), plan
    assert found.count() == 10


def test_few_words_reach_the_scan(spark, corpora, monkeypatch):
    _, index, _ = corpora[0]
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plans, places = [], prune.scored_places
    monkeypatch.setattr(prune, "scored_places", lambda *a: plans.append(places(*a)) or plans[-1])
    last = pq.search("5 the heat", index)
    for df in (*plans, last):
        plan = df._jdf.queryExecution().toString()
        assert df is last or re.search(r"PushedFilters: \[.*In\(word, \[heat,the\]\)", plan)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_no_cross_join_in_batches(spark, corpora):
    requests = spark.createDataFrame(list(enumerate(MESSAGES)), REQUEST_SCHEMA)
    plan = pq.search_batch(requests, corpora[0][1])._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "WindowGroupLimit" in pq.search_batch(
        requests.where("request_id < 3"), corpora[0][1])._jdf.queryExecution().toString()


def test_index_round_trip_and_invariants(spark, corpora, tmp_path):
    plain, index, df = corpora[0]
    path = str(tmp_path / "again")
    pq.write_index(df, path)
    again = pq.load_index(spark, path)
    for name in ("postings", "vocabulary", "page_stats", "directory", "page_targets"):
        assert rows(getattr(again, name)) == rows(getattr(index, name))
    tf = again.postings.agg(F.sum("tf")).first()[0]
    assert tf == again.page_stats.agg(F.sum("n_words")).first()[0] == sum(plain.n_words.values())
    assert again.page_stats.where("max_tf > n_words").count() == 0
    assert again.vocabulary.agg(F.max("df")).first()[0] <= again.page_stats.count()
    frequent = rows(pq.word_count(df))
    totals = rows(again.postings.groupBy("word").agg(F.sum("tf").alias("n")).where("n > 1"))
    assert frequent == totals


def test_fetch_and_result_list_keep_the_order(spark, corpora):
    plain, index, df = corpora[1]
    requests = spark.createDataFrame([(0, "9 the heat of")], REQUEST_SCHEMA)
    results = pq.search_batch(requests, index)
    expected = plain.search("9 the heat of")
    assert [r["id"] for r in pq.fetch_pages(results, df).collect()] == expected
    listed = pq.result_list(results, df).collect()
    texts = {p[0]: (p[1], p[3]) for p in corpus(2)}
    assert [(r["id"], r["title"], r["abstract"]) for r in listed] == [(i, *texts[i]) for i in expected]


def test_pages_are_fetched_from_their_buckets(spark, tmp_path):
    """Five thousand ids: beyond a scan filter, so the folders tell what is read."""
    pages = spark.range(20_000).select("id", F.format_string("Page %d", "id").alias("title"), F.lit("x").alias("text"))
    store = store_by_id(pages, str(tmp_path / "pages"), 64)
    wanted = [i for i, b in store.select("id", "id_bucket").collect() if b < 17][:5000]
    results = spark.createDataFrame([(0, n + 1, i) for n, i in enumerate(wanted)], "request_id long, rank int, id long")
    found = pq.fetch_pages(results, store)
    plan = found._jdf.queryExecution().executedPlan().toString()
    buckets = re.search(r"PartitionFilters: \[[^]]*id_bucket#\d+ (?:IN|INSET) [^]]*", plan).group()
    assert len(re.findall(r"\b\d+\b(?!L?#)", buckets.split("IN")[-1])) <= 17
    assert [tuple(r) for r in found.collect()] == [(0, n + 1, i, f"Page {i}", "x") for n, i in enumerate(wanted)]


def test_long_lists_are_ranked_over_many_tasks(spark, monkeypatch):
    """One request with all rows: its ranks come from several partitions."""
    placed, stored = [], toplist.stored
    monkeypatch.setattr(toplist, "stored", lambda *a: placed.append(stored(*a)) or placed[-1])
    df = spark.range(30_000).select(F.lit(7).alias("request_id"), ((F.col("id") * 7919) % 30_011).alias("place"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = toplist.top_per_group(df, ["request_id"], [F.desc("place")], F.lit(20_000), 1_000_000, "rank")
        got = sorted((r["rank"], r["place"]) for r in ranked.collect())
        assert "Window [row_number" not in ranked._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    places = sorted(((i * 7919) % 30_011 for i in range(30_000)), reverse=True)
    assert got == [(n + 1, p) for n, p in enumerate(places[:20_000])]
    assert placed[0].groupBy("_part").count().where("count < 20000").count() > 1
    few = spark.createDataFrame([("a", 3, 1), ("a", 3, 2), ("a", 1, 3), (None, 2, 4)], "g string, o int, id int")
    once = toplist.top_per_group(few, ["g"], [F.col("o")], F.lit(5), 5_000, "rank", distinct_order=True)
    assert sorted(((r["g"] or "", r["o"], r["rank"]) for r in once.collect())) == [("", 2, 1), ("a", 1, 1), ("a", 3, 2)]


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_many_prefixes_are_looked_up_by_range(spark, tmp_path, ranges):
    rng = random.Random(ranges)
    titles = ["".join(rng.choices("ab c", k=rng.randrange(0, 7))) for _ in range(500)] + ["a"] * 40
    directory = spark.createDataFrame([(i, t, t) for i, t in enumerate(titles)], "id long, title string, title_norm string")
    store = store_by_title(directory, str(tmp_path / "directory"), ranges)
    starts = spark.read.parquet(str(tmp_path / "directory_ranges"))
    prefixes = sorted({t[:n] for t in titles[:300] for n in (1, 2, 3, 5)} | {"zz", "", "~"})
    wanted = spark.createDataFrame([(p,) for p in prefixes], "prefix string")
    found = tl.title_prefix_search(wanted, store, 5, 7, starts=starts)
    plan = found._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    expected = []
    for p in prefixes:
        hits = sorted({str(i) for i, t in enumerate(titles) if p and t.startswith(p)})
        expected += [(p, int(i), n + 1) for n, i in enumerate(hits[:5])]
    assert rows(found, "prefix", "id", "title_rank") == sorted(expected)


def test_limits_beyond_32_bits(spark, corpora):
    plain, index, _ = corpora[0]
    for msg in ("3000000000 the cat", "-99999999999999999999 the"):
        assert [r["id"] for r in pq.search(msg, index).collect()] == plain.search(msg)


def test_weights(spark):
    df = spark.createDataFrame([(1,), (2,), (10,)], "df long")
    got = [r[0] for r in df.select(pq.term_weight("df")).collect()]
    assert got[0] == math.inf and got[1:] == pytest.approx([1 / math.log(2), 1 / math.log(10)])


def test_terms_by_df(spark, corpora):
    _, index, _ = corpora[0]
    parsed = pq.parse_request(spark.createDataFrame([(0, "5 the heat the nosuch")], REQUEST_SCHEMA))
    got = pq.terms_by_df(rk.distinct_terms(parsed), index.vocabulary).collect()
    assert [(r["word"], r["repeats"]) for r in got] == [("heat", 1), ("the", 2)]


def test_long_queries_do_not_lose_precision(spark):
    """A product of many small weights would be zero; its logarithm is not."""
    matches = spark.createDataFrame(
        [(0, f"w{i}", 1, 1000 + i, page, 1 + page, 500) for i in range(2000) for page in (1, 2)],
        "request_id long, word string, repeats long, df long, id long, tf long, n_words long",
    )
    matches = matches.withColumn("ln_weight", rk.log_weight("df"))
    got = {r["id"]: r["ln_score"] for r in pq.score_by_length(matches).collect()}
    base = -sum(math.log(math.log(1000 + i)) for i in range(2000)) - math.log(500)
    assert got[1] == pytest.approx(base + 2000 * math.log(2), abs=1e-6)
    assert got[2] == pytest.approx(base + 2000 * math.log(3), abs=1e-6)


def test_a_third_of_all_pages_are_copies(spark, tmp_path):
    """Copies of one record share its id: their words add up, their results do not."""
    pages = corpus(5)
    pages += [pages[0]] * (len(pages) // 2)
    df = spark.createDataFrame(pages, PAGE_SCHEMA)
    index = pq.write_index(df, str(tmp_path / "copies"))
    plain = Plain(pages)
    assert rows(index.page_stats) == sorted((p, plain.n_words[p], plain.max_tf[p]) for p in plain.n_words)
    requests = spark.createDataFrame(list(enumerate(MESSAGES)), REQUEST_SCHEMA)
    assert answers(pq.search_batch(requests, index), MESSAGES) == [plain.search(m) for m in MESSAGES]


def test_nothing_to_search(spark, corpora):
    _, index, _ = corpora[0]
    none = spark.createDataFrame([], REQUEST_SCHEMA)
    assert pq.search_batch(none, index).collect() == []
    for msg in ("5 nosuchword", "5", "0 the", "-3 12 ..."):
        assert pq.search(msg, index).collect() == []


def test_buckets_are_bounded(spark):
    """A task sorts a bucket, so there are as many as the corpus takes."""
    for pages, postings in ((3_000_000, 900_000_000), (30_000, 900_000_000)):
        buckets, _ = index_store.bucket_counts(spark, pages, postings)
        assert pages / buckets <= 10_000 and postings / buckets <= 3_000_000
    assert index_store.bucket_counts(spark, 500, 5_000)[0] == 1


def test_plain_pages_are_shuffled_once(spark, corpora):
    """Pages that stand for themselves are dealt out without a join of page rows or a sum."""
    _, index, df = corpora[0]
    terms = wd.page_terms(df, ("title", "redirect_title"))
    targets = index.page_targets
    records = terms.groupBy("id").agg(F.count("*").alias("records"))
    facts = index.page_stats.join(records, "id").join(targets, "id", "left")
    plain, others = index_store.postings_by_page(terms, facts, 3, 4)
    plan = plain._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 1 and "SortMergeJoin" not in plan
    assert "HashAggregate(keys=[home" not in plan
    columns = ["word", "id", "tf", "n_words", "max_tf", "result_id"]
    assert rows(plain.unionByName(others).select(*columns).na.fill(-1)) == rows(index.postings.select(*columns).na.fill(-1))
    assert others.count() > 0


def test_repeated_and_redirected_records_in_the_index(spark, tmp_path):
    """Records that share an id, a page that redirects to itself, and one without an id."""
    words = " ".join(["the heat"] * 60)
    pages = [
        (1, "Page a", "", "", words), (2, "Page b", "", "", "the sun"), (2, "Page b", "", "", words),
        (3, "Page c", "Page C", "", "the moon"), (4, "Page d", "Page a", "", "the star"), (5, "Page e", "", "", ""),
        (None, "Page f", "", "", "the none"),
    ]
    index = pq.write_index(spark.createDataFrame(pages, PAGE_SCHEMA), str(tmp_path / "index"))
    found = rows(index.postings.select("word", "id", "tf", "n_words", "max_tf", F.coalesce("result_id", F.lit(-1))))
    assert found == sorted([
        ("the", 1, 60, 120, 60, 1), ("heat", 1, 60, 120, 60, 1),
        ("the", 2, 61, 122, 61, 2), ("heat", 2, 60, 122, 61, 2), ("sun", 2, 1, 122, 61, 2),
        ("the", 3, 1, 2, 1, 3), ("moon", 3, 1, 2, 1, 3), ("the", 4, 1, 2, 1, 1), ("star", 4, 1, 2, 1, 1),
    ])


def test_scores_that_lie_by_home_are_resolved_there(spark, corpora):
    """Results are the same with and without ``home``, and it leaves the result's columns alone."""
    _, index, _ = corpora[0]
    requests = spark.createDataFrame([(1, "10 the heat"), (2, "5 of the sun")], REQUEST_SCHEMA)
    terms = rk.distinct_terms(pq.parse_request(requests))

    def resolved(*columns):
        postings = index.paged.select("word", "id", "tf", "n_words", "max_tf", *columns)
        return pq.redirect_resolve(pq.score_by_length(pq.term_lookup(terms, postings, index.vocabulary)), index.page_targets)

    assert resolved("home").columns == resolved().columns
    assert rows(resolved("home")) == rows(resolved()) != []
    assert rows(pq.dedup_results(rk.body_places(resolved("home"))).select("request_id", "id", "place.*")) == rows(
        pq.dedup_results(rk.body_places(resolved())).select("request_id", "id", "place.*")
    )


def test_many_targets_do_not_move_the_scores(spark, tmp_path, monkeypatch):
    """Beyond the limit of a broadcast, scores of an index stay in their buckets until they are results."""
    words = " ".join(["the heat"] * 60)
    pages = [(i, f"Page {i}", "", "", words + " sun" * i) for i in range(40)]
    # Many redirects to one page, few to others, and short pages without a result.
    pages += [(100 + i, f"Other {i}", f"Page {0 if i < 70 else i % 40}", "", "the heat") for i in range(90)]
    pages += [(200 + i, f"Short {i}", "", "", "the sun") for i in range(30)]
    index = pq.write_index(spark.createDataFrame(pages, PAGE_SCHEMA), str(tmp_path / "index"), page_buckets=3)
    requests = spark.createDataFrame([(1, "10 the heat"), (2, "5 sun the")], REQUEST_SCHEMA)
    terms = rk.distinct_terms(pq.parse_request(requests))

    def resolved(*columns, targets=index.page_targets):
        postings = index.paged.select("word", "id", "tf", "n_words", "max_tf", *columns)
        return pq.redirect_resolve(pq.score_by_length(pq.term_lookup(terms, postings, index.vocabulary)), targets)

    some = index.page_targets.where("id % 3 > 0").unionByName(spark.createDataFrame([(5, 6), (None, 7), (8, None)], "id long, result_id long"))
    plain, plain_some = rows(resolved()), rows(resolved("home", targets=some))
    best = rows(pq.dedup_results(rk.body_places(resolved())).select("request_id", "id", "place.*"))
    monkeypatch.setattr(sizing.is_small, "__defaults__", (2, 10))
    found = resolved("home")
    assert found.columns == resolved().columns and rows(found) == plain and len(plain) == 2 * 130
    assert rows(resolved("home", targets=some)) == plain_some and 0 < len(plain_some) < len(plain)
    places = pq.dedup_results(rk.body_places(found))
    plan = places._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin [home" in plan and "hashpartitioning(request_id" not in plan
    assert re.findall(r"Exchange hashpartitioning\(home[^)]*\), (\w+)", plan) == ["REPARTITION_BY_NUM"]
    assert rows(places.select("request_id", "id", "place.*")) == best and len(best) == 2 * 40


def test_a_value_in_a_sorted_array(spark):
    numbers = [-7, -7, 0, 3, 4, 9, 9, 12, 40]
    asked = spark.createDataFrame([(n, numbers[:n], v) for n in range(10) for v in range(-9, 42)] + [(0, [1], None)], "n int, l array<int>, v int")
    for row in asked.select("l", "v", rk.in_sorted("l", "v").alias("found")).collect():
        assert row["found"] == (row["v"] in row["l"])


def test_matches_that_lie_by_id_are_not_shuffled(spark):
    """Scores of dealt pages: nothing but page rows, page statistics and few terms goes through an exchange."""
    pages = spark.createDataFrame([(i, "the heat of " + "x" * (i % 5 + 1)) for i in range(50)], "id long, content string")
    terms = wd.dealt_terms(sizing.stored(wd.page_terms(pages), "page-terms"))
    requests = spark.createDataFrame([(i, f"3 the heat {'x' * (i % 5 + 1)}") for i in range(5)], REQUEST_SCHEMA)
    postings = wd.postings_of(terms)
    wanted = rk.distinct_terms(pq.parse_request(requests))
    scored = pq.score_by_length(pq.term_lookup(wanted, postings, pq.document_frequency(postings)), wd.page_stats(terms))
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning(request_id" not in plan and "ShuffledHashJoin" in plan
    assert scored.count() == 250
