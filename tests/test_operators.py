import itertools
import random

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import components, dedup, filters, judge, language, masking, minhash, quality, registry, sampling, segment, stats

DOC = "doc_id long, text string"


def test_length_filters(frame, rows):
    df = frame([(n, "x" * n) for n in (19, 20, 21, 100_000, 100_001)] + [(0, None)], DOC)
    assert rows(filters.length_filter(df), "doc_id") == [(100_000,), (20,), (21,)]
    assert rows(filters.length_filter(df, strict=True), "doc_id") == [(21,)]


def test_score_filter_coerces_and_drops_repeats(frame, rows):
    t = "x" * 30
    df = frame([("0.5", t), ("0.5", t), ("0.7", t), ("bad", t), (None, t), ("nan", t), ("0.1", t)], "score string, text string")
    assert rows(filters.score_filter(df, "score", ["text"], 0.2, 0.9), "score") == [(0.5,), (0.7,)]


def test_first_failing_charges_the_first_stage(frame, rows):
    df = frame([(1, True, True), (2, None, True), (3, False, False)], "i int, a boolean, b boolean")
    assert rows(df.select("i", filters.first_failing([("a", F.col("a")), ("b", F.col("b"))]))) == [(1, "a"), (2, "b"), (3, None)]


def test_domain_filter_and_rescore(frame, rows):
    df = frame([(1, "a"), (2, "b"), (3, None)], "i int, d string")
    assert rows(filters.domain_filter(df, F.col("d"), frame([("a",), ("a",)], "domain string")), "i") == [(1,)]
    scored = frame([(1, None), (2, "-1"), (3, "0"), (4, "5"), (5, "6")], "i int, s string")
    assert rows(filters.rescore_candidates(scored, "s"), "i") == [(1,), (2,), (5,)]


def test_c4_rules(spark, frame):
    long = "This is one good sentence here. And two. And three. And four. And five."
    cases = ["see javascript here now\n" + long, long + " lorem ipsum", long + " {", "our privacy policy applies here\n" + long, "cited [1] text here\n" + long, None, ""]
    df = frame(list(enumerate(cases)), "i int, text string", 1).withColumn("r", quality.c4_text(F.col("text")))
    got = {r.i: (r.r, r.bad) for r in df.select("i", "r", quality.c4_bad(F.col("text"), F.col("r")).alias("bad")).collect()}
    assert got[0] == (long, False) and got[3] == (long, False)
    assert got[1][1] and got[2][1] and got[4][0].startswith("cited  text here") and got[5] == (None, True) and got[6] == ("", True)


def test_repetition_by_hand():
    shares = dict(zip(quality.REPETITION[1:], quality.repetition_shares("a b a b a b\nsame line\nsame line")))
    assert shares["dup_lines"] == pytest.approx(1 / 3) and shares["top_2"] > 0
    assert quality.repetition_shares(None) == quality.repetition_shares(" \n ") == [0.0] * 13
    once = quality.repetition_shares("one two three four five six seven eight nine ten eleven")
    assert once == [0.0] * 13


def test_cascade_charges_repetition_before_quality(frame, rows):
    df = frame([(1, "en", "x y\n" * 20), (2, "de", "x"), (3, "en", "short text"), (4, None, None)], "doc_id long, lang string, text string")
    assert rows(quality.cascade(df, F.col("lang"), ["en"]), "doc_id", "reject_stage") == [(1, "repetition"), (2, "language"), (3, "quality"), (4, "language")]


def test_dedup_keeps_first_and_is_idempotent(frame, rows):
    df = frame([(3, "a"), (1, "a"), (2, None), (4, None), (5, "b")], DOC)
    once = dedup.keep_first(df, ["text"], "doc_id")
    assert rows(once, "doc_id") == [(1,), (5,)] or rows(once, "doc_id") == [(1,), (2,), (5,)]
    assert rows(dedup.keep_first(once, ["text"], "doc_id")) == rows(once)
    assert rows(dedup.dedup_metrics(df, ["text"])) == [(5, 2, 3)]
    assert rows(dedup.dedup_metrics(df.where("false"), ["text"])) == [(0, 0, 0)]


def test_dedup_stats_adds_up(frame):
    t = "x" * 30
    df = frame([(1, t), (2, t), (3, "short"), (4, None), (5, t + "y")], DOC)
    r = dedup.dedup_stats(df, F.md5("text")).first()
    assert (r.processed, r.length_errors, r.duplicates, r.unique_rows) == (5, 2, 1, 2) and r.rate == pytest.approx(1 / 3, abs=1e-6)


def test_anti_join_treats_null_as_equal(frame, rows):
    df, other = frame([(1, "a"), (2, None), (3, "c")], DOC), frame([(9, None), (8, "a")], DOC)
    assert rows(dedup.remove_overlap(df, other, F.col("text"), F.col("text")), "doc_id") == [(3,)]


def test_registry(spark, frame, rows, tmp_path):
    table = registry.KeyRegistry(spark, f"file://{tmp_path}/keys", shards=10, folders=3)
    assert rows(table.status()) == []
    table.add(frame([("a",), ("b",), (None,), ("a",)], "key string"))
    table.add(frame([("b",), ("c",), ("",)], "key string"))
    assert rows(table.keys(), "key") == [("",), ("a",), ("b",), ("c",)]
    assert rows(table.check(frame([("a",), ("z",), (None,)], "key string")), "key", "known") == [("a", True), ("z", False), (None, False)]
    shard = table.keys().where("key = 'a'").first().shard
    table.clear(shard)
    assert "a" not in {r.key for r in table.keys().collect()}
    table.clear()
    assert rows(table.keys()) == []


@pytest.mark.parametrize("partitions", [1, 4])
def test_components_of_chain_star_and_cycle(frame, partitions):
    chain = [(i, i + 1) for i in range(1, 40)]
    star = [(100, i) for i in range(101, 160)]
    edges = frame(chain + star + [(200, 201), (201, 202), (202, 200), (7, 7), (None, 3)], "a long, b long", partitions)
    got = dict(components.components(edges).collect())
    assert {got[i] for i in range(1, 41)} == {1} and {got[i] for i in range(100, 160)} == {100} and {got[i] for i in (200, 201, 202)} == {200}


def _shingles(text, n=5):
    w = [x for x in "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()]
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def test_near_duplicates_against_brute_force(frame):
    source = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(60):
        base = [source.choice(vocabulary) for _ in range(120)]
        texts.append(" ".join(base))
        for _ in range(source.randrange(3)):
            copy = list(base)
            copy[source.randrange(len(copy))] = "changed"
            texts.append(" ".join(copy))
    texts += [texts[0]] * 30 + ["too short", "too short", "", None]
    docs = list(enumerate(texts))
    found = {r.doc_id: r.class_id for r in minhash.near_duplicates(frame(docs, DOC, 3)).collect()}
    assert len(found) == len(docs)
    sets = {i: _shingles(t or "") for i, t in docs}
    links = hits = 0
    for i, j in itertools.combinations(sets, 2):
        a, b = sets[i], sets[j]
        if a and b and len(a & b) / len(a | b) >= 0.8:
            links += 1
            hits += found[i] == found[j]
    assert links > 400 and hits >= 0.9 * links
    assert all(found[i] == i for i, s in sets.items() if not s)


def test_near_duplicates_compares_all_pairs_of_mixed_buckets(frame, monkeypatch):
    template = [f"t{i}" for i in range(200)]
    docs = []
    for k in range(16):
        own = list(template)
        own[10 * k + 10] = f"own{k}"
        docs += [(k, " ".join(own)), (100 - k, " ".join([*own[:-1], "end"]))]  # twins share buckets with the texts between them
    sets = {i: _shingles(t) for i, t in docs}
    alike = [(i, j) for i, j in itertools.combinations(sorted(sets), 2) if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.95]
    assert alike == [(k, 100 - k) for k in range(16)]
    for block in (minhash.BLOCK, 3):
        monkeypatch.setattr(minhash, "BLOCK", block)
        strict = {r.doc_id: (r.class_id, r.links) for r in minhash.near_duplicates(frame(docs, DOC), 0.95).collect()}
        assert strict == {i: (min(i, 100 - i), 1) for i in sets}
        loose = minhash.near_duplicates(frame(docs, DOC), 0.8).collect()
        assert all(r.class_id == 0 and r.links == len(docs) - 1 for r in loose)


def test_near_duplicates_of_any_script(frame):
    source = random.Random(9)
    make = lambda letters, size, blank: blank.join("".join(source.choice(letters) for _ in range(size)) for _ in range(200))
    docs = []
    for k, (letters, size, blank) in enumerate([("абвгдежзиклмн", 6, " "), ("ابتثجحخدذرز", 6, " "), ("가나다라마바사", 4, " "), ("天地人山水火木金土日月星", 1, ""), ("あいうえおかきくけこ", 1, "")]):
        text = make(letters, size, blank)
        docs += [(10 * k, text), (10 * k + 1, text + " " + make(letters, size, blank)[:6]), (10 * k + 2, make(letters, size, blank))]
    docs += [(90, "déjà vu été où ça"), (91, "de\u0301ja\u0300 vu e\u0301te\u0301 ou\u0300 c\u0327a"), (92, "dèjà vu été où ça")]
    docs += [(100, "too short"), (101, "too short"), (102, "短"), (103, "短"), (104, None), (105, None), (106, ""), (107, "")]
    found = {r.doc_id: r.class_id for r in minhash.near_duplicates(frame(docs, DOC), short_copies=True).collect()}
    joined = {i: i - 1 for i in (1, 11, 21, 31, 41, 91, 101, 103, 107)}
    assert found == {i: joined.get(i, i) for i, _ in docs}


def test_signatures_agree(frame):
    docs = frame([(1, "a b c d e f g"), (2, "a b c"), (3, None), (4, "A-b c d e F g!")], DOC)
    slow = {r.doc_id: r.signature for r in minhash.signatures(minhash.shingles(docs)).collect()}
    fast = {r.doc_id: r.signature for r in minhash.fast_signatures(docs).collect()}
    assert slow == fast and set(fast) == {1, 4} and fast[1] == fast[4]


def test_score_distribution_has_all_bins(frame):
    df = frame([(3,), (3,), (9,), (None,), (0,)], "s int")
    got = {r.score: (r["count"], r.percent) for r in stats.score_distribution(df, F.col("s")).collect()}
    assert got[3] == (2, 66.67) and got[-1] == (2, 40.0) and got[5] == (0, 0.0) and len(got) == 7


def test_confusion_counts_unknown_in_total_only(frame):
    df = frame([(True, True), (True, None), (False, True), (False, False), (None, True)], "t boolean, g boolean")
    r = stats.confusion(df, F.col("t"), F.col("g")).first()
    assert (r.total, r.tp, r.fp, r.fn, r.tn) == (5, 1, 1, 1, 1) and r.f1 == 0.5
    empty = stats.confusion(df.where("false"), F.col("t"), F.col("g")).first()
    assert empty.total == 0 and empty.precision == 0


def test_ratio_of_counts(frame, rows):
    base, other = frame([("a", 2), ("b", 3)], "domain string, count long"), frame([("a", 4), ("b", 0), ("c", 9)], "domain string, count long")
    assert rows(stats.ratio_of_counts(base, other, "domain")) == [("a", 2, 4, 0.5), ("b", 3, 0, None)]


def test_group_by_drops_null_and_empty(frame, rows):
    assert rows(stats.count_by(frame([("x",), ("x",), (None,), ("",)], "u string"), F.col("u"))) == [("x", 2)]


@pytest.mark.parametrize("partitions", [1, 4])
def test_sampling_is_deterministic(frame, rows, partitions):
    df = frame([(i, f"g{i % 3}", f"t{i}") for i in range(300)], "i long, g string, t string", partitions)
    taken = rows(sampling.sample_per_group(df, F.col("g"), F.col("i"), 30), "i")
    assert len(taken) == 30 and taken == rows(sampling.sample_per_group(df.repartition(7), F.col("g"), F.col("i"), 30), "i")
    split = {r.i: r.split for r in sampling.train_val_split(df, F.col("g"), F.col("i")).collect()}
    assert len(split) == 300 and all(sum(split[i] == "train" for i in range(300) if i % 3 == k) == 80 for k in range(3))


def test_bins_are_right_closed(frame):
    df = frame([(0.0,), (0.3,), (0.31,), (0.9,), (3.0,), (3.01,), (-1.0,), (None,)], "p double")
    assert sorted((r[0], r[1]) for r in df.select("p", sampling.bin_of(F.col("p"))).collect() if r[1]) == [(0.3, 1), (0.31, 2), (0.9, 3), (3.0, 10)]


def test_stratified_sample_repeats_short_bins(frame):
    df = frame([(i, 0.1) for i in range(50)] + [(100, 0.5), (101, 0.55)], "i long, p double")
    got = sampling.stratified_sample(df, F.col("p"), F.col("i"), 100).groupBy("bin").count().collect()
    assert {r.bin: r["count"] for r in got} == {1: 10, 2: 10}
    more = sampling.stratified_sample(df, F.col("p"), F.col("i"), 100, redistribute=True)
    assert more.count() == 100


def test_sentences_and_segments():
    assert segment.sentences("Dr. Lee met Mr. X in the U.S. today. Why? Plan A. is fine! Tail")[-1] == "Tail"
    assert len(segment.sentences("Dr. Lee met Mr. X in the U.S. today. Why? Plan A. is fine! Tail")) == 4
    assert len(segment.sentences('He said "go." Then left.')) == 1
    assert segment.segments(None) == segment.segments(" \n") == []
    source = random.Random(1)
    text = " ".join(f"w{i}" + ("." if source.random() < 0.05 else "") for i in range(8000)) + ". However it went on."
    parts = segment.segments(text)
    assert " ".join(parts).split() == text.split() and all(segment.words_in(p) >= 500 for p in parts[:-1])


def test_language_guess(frame):
    cases = ["the bus and the tram were late", "der Bus und die Bahn", "xyz", None]
    got = language.with_language(frame(list(enumerate(cases)), DOC.replace("doc_id long", "i int"), 1)).sort("i").collect()
    assert [r.language for r in got] == ["en", "de", None, None]


def test_judge_validates_and_resumes(frame, rows):
    df = frame([(1, "a bus on the road"), (2, ""), (3, None), (4, "nothing")], DOC)
    assert rows(judge.judge(df, "doc_id")) == [(1, 2), (2, 0), (3, 0), (4, 0)]
    assert rows(judge.judge(df, "doc_id", lambda texts: ["6" for _ in texts])) == [(1, -1), (2, 0), (3, 0), (4, -1)]

    def broken(texts):
        raise OSError

    assert rows(judge.judge(df, "doc_id", broken))[0] == (1, -1)
    scored = df.withColumn("s", F.when(F.col("doc_id") == 4, "5"))
    assert rows(judge.rescored(scored, "doc_id", "s"), "doc_id", "s") == [(1, 2), (2, 0), (3, 0), (4, 5)]


def test_masking(frame):
    df = frame([("mail a.b@c.org or 10.1.2.3", "<p>a&amp;b</p><script>x</script>")], "t string, h string")
    assert tuple(df.select(masking.mask_addresses(F.col("t")), masking.html_text(F.col("h"))).first()) == ("mail email@example.com or 192.0.2.1", "a&b")


def test_near_duplicates_recall_near_the_threshold(frame):
    source = random.Random(17)
    texts, pairs = [], []
    for k in range(150):
        base = [f"w{source.randrange(5000)}" for _ in range(200)]
        near = list(base)
        for at in (20, 70, 120, 170):
            near[at] = f"new{k}"
        pairs.append((len(texts), len(texts) + 1))
        texts += [" ".join(base), " ".join(near)]
    sets = [_shingles(t) for t in texts]
    assert all(0.8 <= len(sets[a] & sets[b]) / len(sets[a] | sets[b]) <= 0.85 for a, b in pairs)
    found = {r.doc_id: r.class_id for r in minhash.near_duplicates(frame(list(enumerate(texts)), DOC, 3)).collect()}
    assert sum(found[a] == found[b] for a, b in pairs) >= 0.9 * len(pairs)


def test_near_duplicates_within_a_folder(frame):
    source = random.Random(18)
    words = [f"w{source.randrange(5000)}" for _ in range(300)]
    change = lambda at: " ".join(w if i not in at else f"x{i}" for i, w in enumerate(words))
    a, b, c = change(range(20, 100, 20)), change([]), change(range(150, 230, 20))
    j = lambda x, y: len(_shingles(x) & _shingles(y)) / len(_shingles(x) | _shingles(y))
    assert j(a, b) >= 0.8 and j(b, c) >= 0.8 and j(a, c) < 0.8
    docs = frame([(1, "f", a), (2, "g", b), (3, "f", c), (4, "f", c), (5, None, "short"), (6, None, "short"), (7, "f", "short")], "doc_id long, folder string, text string")
    classes = {r.doc_id: r.class_id for r in minhash.near_duplicates(docs, short_copies=True, scope=F.col("folder")).collect()}
    assert classes == {1: 1, 2: 2, 3: 3, 4: 3, 5: 5, 6: 5, 7: 7}


def test_nan_is_a_missing_value(frame, rows):
    df = frame([(1, 0.5), (1, 0.5), (2, float("nan")), (2, None), (2, float("nan"))], "i long, p double")
    assert rows(dedup.dedup_rows(df)) == [(1, 0.5), (2, None)]


def test_keep_first_of_keys_with_a_shared_order(frame, rows):
    df = frame([(1, "a", None), (2, "a", None), (1, "b", None), (1, None, "a"), (2, None, "a"), (3, None, None)], "n long, s string, t string")
    assert rows(dedup.keep_first(df, ["s", "t"], "n")) == sorted([(1, "a", None), (1, "b", None), (1, None, "a"), (3, None, None)], key=str)


def test_a_failed_call_costs_only_its_texts(frame, rows):
    def reply(texts):
        if any("bad" in t for t in texts):
            raise OSError
        return ["3" if "good" in t else "unsure" for t in texts]

    df = frame([(1, "good"), (2, "bad"), (3, "good too"), (4, "else")], DOC, 1)
    assert rows(judge.judge(df, "doc_id", reply)) == [(1, 3), (2, -1), (3, 3), (4, -1)]
    asked = []
    assert judge.replies_of(["a", "b"], lambda texts: asked.append(texts) or ["x"] * len(texts), retries=1) == ["x", "x"] and asked == [["a", "b"], ["a"], ["b"]]


def test_judged_parts_are_saved(spark, frame, rows, tmp_path):
    df, path = frame([(i, "bus") for i in range(20)] + [(30, None)], DOC), f"file://{tmp_path}/scores"
    first = rows(judge.judge_saved(df, "doc_id", path, parts=3))
    assert first == sorted([(i, 1) for i in range(20)] + [(30, 0)], key=str)

    def broken(texts):
        raise AssertionError("asked again")

    assert rows(judge.judge_saved(df, "doc_id", path, broken, parts=3)) == first


def test_language_and_url_filters(frame, rows):
    df = frame([(1, "en-GB", 0.9), (2, "EN", 0.2), (3, "de", 0.9), (4, None, 0.9), (5, "en", None), (6, "en", float("nan"))], "i int, l string, s double")
    assert rows(filters.language_filter(df, F.col("l"), ["en"], F.col("s")), "i") == [(1,)]
    pages = frame([(1, "http://a.bad.org/x"), (2, "http://bad.org:80/"), (3, "http://notbad.org/"), (4, "http://c.d/Casino"), (5, None)], "i int, url string")
    assert rows(filters.url_filter(pages, F.col("url"), frame([("BAD.org",), (None,)], "host string"), ("casino",)), "i") == [(3,), (5,)]


def test_precision_at_one(frame):
    df = frame([(True, True), (True, None), (False, True), (None, True)], "t boolean, g boolean")
    assert tuple(stats.precision_at_one(df, F.col("t"), F.col("g")).first()) == (3, 0.5, 0.333333)
    assert tuple(stats.precision_at_one(df.where("false"), F.col("t"), F.col("g")).first()) == (0, 0.0, 0.0)
