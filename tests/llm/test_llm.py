import itertools
import math
import os
import random
from collections import Counter
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

llm = pytest.importorskip("corpusmill.llm")
from corpusmill.llm import boilerplate, cutoff, frequent, langid, leak, seen, spam, subjects, textstats, tokens, units  # noqa: E402

DOC = "doc_id long, text string"


# --- p1 ---


@pytest.mark.parametrize("partitions", [1, 4])
def test_frequent_items_against_brute_force(frame, rows, partitions):
    source = random.Random(2)
    values = ["hot"] * 400 + [f"v{source.randrange(30)}" for _ in range(600)] + [f"once{i}" for i in range(300)] + [None] * 50 + [""] * 40
    df = frame([(v, 1) for v in values], "u string, n int", partitions)  # n clashes with the count's name
    counts = Counter(v for v in values if v is not None)
    total = sum(counts.values())
    expected = sorted((v, c, total) for v, c in counts.items() if c * 100 >= total)
    assert rows(frequent.frequent_items(df, {"u": (F.col("u"), "0.01")}), "item", "n", "total") == sorted(expected, key=str)
    assert frequent.frequent_items(df.where("false"), {"u": (F.col("u"), "0.01")}).count() == 0
    assert rows(frequent.frequent_items(df.limit(1), {"u": (F.col("u"), "1")}), "n") in ([(1,)], [])


def test_frequent_items_rejects_bad_shares(frame):
    with pytest.raises(ValueError):
        frequent.frequent_items(frame([("a",)], "u string"), {"u": (F.col("u"), "0")})


# --- p2 ---

WORDS = {
    "en": "the house and this water with they have been good morning friend because always every children street".split(),
    "de": "das haus und dieses wasser mit sie haben gewesen guten morgen freund weil immer jeder kinder strasse".split(),
    "fr": "la maison et cette eau avec ils ont bonjour matin parce toujours chaque enfants rue ville grande".split(),
}


@pytest.fixture(scope="module")
def language_model(spark):
    source = random.Random(3)
    rows = []
    for i in range(240):
        lang = ["en", "de", "fr"][i % 3]
        label = source.choice(["en", "de", "fr"]) if source.random() < 0.1 else lang
        rows.append((str(i), " ".join(source.choice(WORDS[lang]) for _ in range(60)), [label, label.upper(), f"{label}-XX", "und", None][i % 5]))
    return langid.fit(spark.createDataFrame(rows, "id string, text string, label string"))


def test_languages_of_texts_and_lines(frame, rows, language_model):
    source = random.Random(4)
    line = lambda lang, n=12: " ".join(source.choice(WORDS[lang]) for _ in range(n))
    cases = [
        ("a", line("en") + "\n\n" + line("en") + "\n" + line("de")),
        ("b", line("fr", 30)),
        ("c", "xkcd qqqq zzzz 0x3f 77 !!"),
        ("d", None),
        ("e", ""),
        ("f", "他们说这个城市的火车站很安静而且非常方便"),
        ("g", line("fr", 30) + " haus wasser"),
        ("h", line("de", 20000)),
    ]
    got = {(r.id, r.seg_no): r.lang for r in langid.segments(frame(cases, "id string, text string"), language_model).collect()}
    assert got == {("a", -1): "en", ("a", 3): "de", ("b", -1): "fr", ("f", -1): "zh", ("g", -1): "fr", ("h", -1): "de"}


def test_labels_are_compared_by_their_primary_part(frame):
    df = frame([(x,) for x in ("EN-gb", "und", "", None, " de ", "unknown", "zh_TW")], "l string", 1)
    assert [r[0] for r in df.select(langid.primary_label(F.col("l"))).collect()] == ["en", None, None, None, "de", None, "zh"]


def test_language_accuracy_on_held_out_labels(spark):
    directory = "/root/testdata/sf0.01"
    if not os.path.exists(directory):
        pytest.skip("no test data")
    from corpusmill.llm.queries import _texts

    texts = _texts(spark, directory).select(F.concat("tbl", "id").alias("id"), "text", "label")
    held = F.pmod(F.xxhash64("id"), F.lit(4)) == 0
    model = langid.fit(texts.where(~held))
    found = langid.segments(texts.where(held), model).where("seg_no = -1").join(texts.select("id", langid.primary_label(F.col("label")).alias("label")), "id").where("label is not null")
    right, n = found.agg(F.avg((F.col("lang") == F.col("label")).cast("int")), F.count("*")).first()
    assert n > 100 and right > 0.88  # about a tenth of the labels are wrong


# --- p3 ---


def test_chain_never_forgets_and_keeps_its_bound():
    chain = seen.BloomChain(rate=1e-3, capacity=100)
    source = np.random.default_rng(1)
    h = source.integers(0, 1 << 63, (2, 40_000), dtype=np.uint64)
    for i in range(0, 20_000, 500):
        chain.add(*h[:, i : i + 500])
    assert chain.keys == 20_000 and len(chain.layers) > 5 and chain.bound <= 1e-3
    assert chain.maybe(*h[:, :20_000]).all()
    assert chain.maybe(*h[:, 20_000:]).mean() <= 2e-3
    assert not seen.BloomChain().maybe(*h[:, :5]).any()


@pytest.mark.parametrize("partitions", [1, 5])
def test_seen_before_against_brute_force(frame, rows, partitions):
    source = random.Random(7)
    keys = ["hot" if source.random() < 0.33 else f"k{source.randrange(400)}" for _ in range(3000)]
    events = [("s", i // 3, i % 3, None if source.random() < 0.02 else k) for i, k in enumerate(keys)] + [("t", 0, 0, "k1"), ("t", 1, 0, "k1"), ("t", 2, 0, ""), ("t", 3, 0, "")]
    events += [("t", 9, 0, "same"), ("t", 9, 0, "same")]  # one place twice: neither came before the other
    known = [("s", "k3"), ("s", "k3"), ("s", None), ("t", "known")]
    schema = "stream string, id long, pos long, key string"
    got = seen.answers(seen.arrivals(frame(events, schema, partitions), frame(known, "stream string, key string"), rate=0.05))
    expected, first = [], {}
    for s, i, p, k in events:
        if k is not None:
            first[s, k] = min(first.get((s, k), (i, p)), (i, p))
    for s, i, p, k in events:
        if k is not None:
            expected.append((s, i, p, (s, k) in {("s", "k3"), ("t", "known")} or first[s, k] < (i, p)))
    assert rows(got, "stream", "id", "pos", "seen") == sorted(expected, key=str)
    assert got.where("seen and not maybe").count() == 0
    report = {r.stream: r for r in seen.error_report(got).collect()}
    assert report["s"].wrong_rate <= 0.1 and report["t"].asked == 6


def test_seen_before_of_nothing(frame):
    empty = frame([], "stream string, id long, pos long, key string")
    assert seen.answers(seen.arrivals(empty, frame([], "stream string, key string"))).count() == 0


def test_kept_chains(frame, rows):
    known = frame([(f"k{i}",) for i in range(2000)] + [(None,), ("k1",)], "key string")
    chains = seen.extend_chains(known, 4)
    assert sum(r.keys for r in chains.collect()) in range(1990, 2001)
    more = seen.extend_chains(frame([(f"n{i}",) for i in range(500)] + [("k1",)], "key string"), 4, chains)
    assert {r.shard for r in more.collect()} == {0, 1, 2, 3} and sum(r.keys for r in more.collect()) in range(2480, 2501)
    asked = frame([(i, f"k{i}") for i in range(100)] + [(200 + i, f"n{i}") for i in range(50)] + [(1000 + i, f"new{i}") for i in range(3000)] + [(1, None), (7, "k1"), (8, "k1")], "i long, key string")
    got = seen.ask_chains(asked, 4, more).collect()
    assert len(got) == 3153
    assert all(r.maybe for r in got if r.key and not r.key.startswith("new")) and not any(r.maybe for r in got if r.key is None)
    assert sum(r.maybe for r in got if r.key and r.key.startswith("new")) <= 5
    assert seen.ask_chains(asked.limit(3), 4, chains.where("false")).where("maybe").count() == 0


# --- p4 ---


@pytest.mark.parametrize("partitions", [1, 4])
def test_cutoffs_against_brute_force(frame, partitions):
    source = random.Random(9)
    rows = []
    for i in range(3000):
        domain = "hot" if source.random() < 0.5 else source.choice(["a", "b", "zero", "all", "rest", None])
        score = source.choice([0.5, 0.5000001, source.random(), source.random() * 1e-6 + 0.3, None, float("nan"), -0.1, 1.00005, 1.5])
        rows.append((i, domain, score))
    rows += rows[:200]
    targets = [("hot", 37), ("a", 1), ("b", 99), ("zero", 0), ("all", 100), ("*", 30)]
    valid = cutoff.valid_records(frame(rows, "p long, d string, s double", partitions), F.col("p"), F.col("d"), F.col("s"))
    cuts = {r.source: r for r in cutoff.cutoffs(valid, frame(targets, "source string, keep_pct long")).collect()}
    kept = {r.rec for r in cutoff.kept_records(valid, cutoff.cutoffs(valid, frame(targets, "source string, keep_pct long"))).collect()}
    by = {}
    for i, d, s in set((i, d or "", s) for i, d, s in rows if s is not None and s == s and 0 <= s <= 1.0001):
        by.setdefault(d, []).append((s, i))
    expected = set()
    for d, own in by.items():
        pct = dict(targets).get(d, 30)
        n = -(-pct * len(own) // 100)
        cut = sorted((s for s, _ in own), reverse=True)[n - 1] if n else None
        assert (cuts[d].n, cuts[d].target, cuts[d].cutoff) == (len(own), n, cut)
        expected |= {i for s, i in own if cut is not None and s >= cut}
        assert cuts[d].kept == sum(cut is not None and s >= cut for s, _ in own)
    assert kept == expected and set(cuts) == set(by)


def test_cutoffs_without_targets_or_rows(frame):
    valid = cutoff.valid_records(frame([(1, "a", 0.5)], "p long, d string, s double"), F.col("p"), F.col("d"), F.col("s"))
    none = frame([], "source string, keep_pct long")
    assert [(r.target, r.cutoff) for r in cutoff.cutoffs(valid, none).collect()] == [(0, None)]
    assert cutoff.cutoffs(valid.where("false"), none).count() == 0


# --- p5 ---


def test_boilerplate_lines(frame, rows):
    share = ["Share  this\tNOW 12", "share this now 7\r", " share this\xa0now 345", "Share this now 1", "SHARE THIS NOW 0"]
    docs = [(i, "s", date(2024, 1, 1 + i), f"own {'x' * (i + 1)}\n\n{line}\n{line}") for i, line in enumerate(share)]
    docs += [(10 + i, "t", date(2024, 1, 1), "share this now 1\nother") for i in range(4)] + [(20, "s", None, None), (21, None, None, "share this now 1"), (22, "s", None, ""), (23, "s", None, "\n\n")]
    df = frame(docs, "doc_id long, site string, day date, text string")
    found = boilerplate.boilerplate(df)
    assert rows(found) == sorted([(i, n) for i in range(5) for n in (2, 3)], key=str)
    cleaned = {r.doc_id: r.text for r in boilerplate.without_lines(df, found).collect()}
    assert cleaned[0] == "own x\n" and cleaned[10] == "share this now 1\nother" and cleaned[20] is None and cleaned[22] == "" and len(cleaned) == len(docs)
    copies = frame([(i, "s", date(2024, 1, 1), "same text\nline") for i in range(6)], "doc_id long, site string, day date, text string")
    assert {(r.docs, r.clusters, r.days) for r in boilerplate.repeated_lines(boilerplate.keyed_lines(copies)).collect()} == {(6, 1, 1)}


# --- p6 ---


def test_subjects_on_made_up_areas(spark, frame):
    source = random.Random(11)
    terms = {"sea": ["anchor", "harbour", "sailor", "tide"], "farm": ["plough", "harvest", "barn", "cattle"], "ice": ["glacier", "igloo", "skates", "frost"]}
    names = [f"Name{i}" for i in range(50)]

    def text(areas, n=8):
        return " ".join(f"The {source.choice(terms[source.choice(areas)])} near {source.choice(names)} was seen by {source.choice(names)}." for _ in range(n))

    docs, labels = [], []
    for i in range(150):
        area = list(terms)[i % 3] if i % 2 else "sea"
        docs.append((i, text([area]), "en"))
        labels += [(i, area.upper() if i % 5 else area), (i, area)] if source.random() > 0.1 else [(i, source.choice(list(terms)))]
    docs += [(200, text(["sea"]), None), (201, text(["farm"], 6) + " " + text(["ice"], 6), "en"), (202, None, "en"), (203, "", "en"), (204, "Nothing known here at all, nothing at all.", "en"), (205, "anchor", "en")]
    frame_ = frame(docs, "doc_id long, text string, lang string")
    model = subjects.fit(frame_, frame(labels + [(7, "unknown"), (8, None)], "doc_id long, subject string"), list(terms))
    got = {}
    for r in subjects.assigned(subjects.scores(frame_, model)).collect():
        got.setdefault(r.doc_id, set()).add(r.subject)
    right = sum(got.get(i) == {list(terms)[i % 3] if i % 2 else "sea"} for i in range(150))
    assert right >= 145 and got[200] == {"sea"} and got[201] == {"farm", "ice"} and not set(got) & {202, 203, 204, 205}


def test_redundant_rules_are_pruned():
    mined = [(["tram"], "a", 1.0, 20.0), (["big", "tram"], "a", 1.0, 10.0), (["the"], "a", 0.5, 50.0), (["the"], "b", 0.5, 50.0)]
    model = subjects._pruned(mined, ["a", "b"], {("a", "en"): 100, ("b", "en"): 100}, {"tram": "en", "big": "en", "the": "en"})
    assert set(model.rules) == {"tram"} and len(model.rules["tram"]) == 1
    assert model.subject_of("The tram") == 0 and model.subject_of("the") == -1 and model.subject_of("") == -1


# --- p7 and units ---


def test_unit_kinds():
    cases = {
        "Passengers for Xburg change to the night coach at Ytown, where Al Bo runs the desk.": "sentence",
        "passengers for xburg change to the night coach at ytown where al bo runs the desk": "sentence",
        "THE COURT AT XBURG DISMISSED THE CLAIM THAT WAS BROUGHT BY AL BO.": "sentence",
        "Depuis 48 jours, le tramway reste coûteux pour les habitants de X.": "sentence",
        "还需要19个星期，西砚泠沟市政府才能完成停车场的改造，漆汀亭中表示。": "sentence",
        "- tram stop, Xburg/Ytown (80)": "item",
        "la estación de autobuses, Xburg/Ytown": "item",
        "https://a.example/b-c": "links",
        "[buy tram](http://a.example/b)": "links",
        "#buyTramXburg #cheapTram": "tags",
        "tram stop Xburg-31 / best / SKU123 / Ytown sale / 12.30": "tags",
        "Price tram stop Xburg?": "selling",
        "Pas cher passage à niveau Xburg?": "selling",
        "gvh nqd ntddnf gmpnhntf fhqp ffrrw pcdwtfspd": "junk",
        "7+/*:=[3a|2<.5x3^#-87": "junk",
    }
    assert {u: units.KINDS[units.kind_of(u)] for u in cases} == cases
    assert units.KINDS[units.kind_of("")] == "heading" and units.KINDS[units.kind_of("\xa0")] == "junk"


def test_chunked_counts_equal_whole_counts(frame):
    source = random.Random(12)
    parts = ["A short sentence was here.", "tab\tparted", "line\n", "word " * 30, "x" * 90, "«quote.» ", "\n\n", "- item, A/B\n", "终于到了。"]
    for size in (40, 97, 1000):
        texts = [" ".join(source.choice(parts) for _ in range(60)) for _ in range(8)]
        df = frame(list(enumerate(texts)), DOC)
        got = {r.doc_id: [r[c] for c in textstats.SUMS] for r in textstats.sums(df, chunk_chars=size).collect()}
        for i, t in enumerate(texts):
            assert dict(zip(textstats.SUMS, got[i])) == dict(zip(textstats.SUMS, textstats.count(t)))


def test_merge_is_associative():
    text = "One is here. Two was there.\nThree is now; four\tfive six seven eight. \n\n" * 5
    for size in (1, 7, 23):
        states = [textstats.chunk_state(text[i : i + size]) for i in range(0, len(text), size)]

        def fold(xs):
            out = xs[0]
            for x in xs[1:]:
                out = textstats.merge(out, x)
            return out

        tree = fold([fold(states[i : i + 3]) for i in range(0, len(states), 3)])
        assert fold(states) == tree and textstats.finish(tree) == textstats.count(text)


def test_not_prose(frame):
    prose = "The tram stop was closed because of the works, and nobody had been told about it. " * 5
    cases = [prose, "- tram stop, A/B\n" * 20, prose + "\n- a tram, A/B" * 3, "", None, "short", " \n ", "qwrtp sdfgh zxcvb " * 20]
    stats_ = textstats.statistics(textstats.sums(frame(list(enumerate(cases)), DOC)))
    assert {r.doc_id for r in stats_.where("not_prose").collect()} == {1, 7}
    assert stats_.count() == 7


# --- p8 ---


def test_encoding_equals_the_tokenizer_and_decodes(spark, frame):
    texts = ["", None, "Hello  world\n\n 'tis it's 123 ½ Ⅷ ²", "<|endoftext|> is text", "日本語 🎉\ttabs", "a" * 5000, " ", "İ x y", "naïve café " * 500]
    docs = list(enumerate(texts)) + [(100 + i, t) for i, t in enumerate(texts)]
    encode = tokens._encoder(os.path.join(tokens.TOKENIZER_DIR, tokens.VOCABULARY))
    for block in (1, 3000, 10**7):
        got = tokens.encode(frame(docs, DOC, 3), block_chars=block)
        assert {r.doc_id: r.ids for r in got.collect()} == {i: encode(t) if t else [] for i, t in docs}
    back = {r.doc_id: r.text for r in tokens.decode(got, tokens.token_table(spark)).collect()}
    assert back == {i: t or "" for i, t in docs}
    assert tokens.encode(frame([], DOC)).count() == 0


# --- p9 ---


@pytest.mark.parametrize("segment", [1, 2000, 10**7])
def test_leaks_against_brute_force(frame, rows, segment):
    source = random.Random(13)
    words = [f"w{i}" for i in range(40)]
    item = lambda n: [source.choice(words) for _ in range(n)]
    items = [(i, item(30)) for i in range(6)] + [(6, item(11)), (7, [])]
    items.append((8, items[0][1]))
    docs = []
    for i in range(60):
        text = item(source.randrange(120))
        if i % 3 == 0:
            w = source.choice(items[:6])[1]
            n, at = source.choice([11, 12, 13, 30]), source.randrange(10)
            text = text[:20] + [x.upper() for x in w[at : at + n]] + text[20:]
        docs.append((i, source.choice([" ", ", ", "\n"]).join(text)))
    docs += [(100, None), (101, ""), (102, "!!")]
    index = leak.build_index(frame(docs, DOC, 3), segment_chars=segment)
    found = leak.phrases(index, frame([(i, " ".join(w)) for i, w in items] + [(9, None)], "item_id long, text string"))
    expected = set()
    for (d, t), (i, w) in itertools.product(docs, items):
        own = leak.words_of(t)
        grams = {tuple(own[k : k + 12]) for k in range(len(own) - 11)}
        if any(tuple(w[k : k + 12]) in grams for k in range(len(w) - 11)):
            expected.add((d, i))
    assert len(expected) > 5 and set(rows(found)) == expected
    blocks = leak.phrases(index, frame([(i, " ".join(w)) for i, w in items], "item_id long, text string"), block_words=10)
    assert set(rows(blocks)) == expected


def test_proximity(frame, rows):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    far = " ".join(f"{w} " + "x " * 30 for w in item.split())
    docs = frame([(1, "kappa iota theta eta zeta some epsilon delta gamma beta alpha"), (2, far), (3, "alpha beta")], DOC)
    assert rows(leak.near_matches(leak.build_index(docs), frame([(5, item)], "item_id long, text string"))) == [(1, 5, 10)]


# --- p10 ---


def _longest_repeats(w):
    out = []
    for i in range(len(w)):
        best = 0
        for k in range(1, i + 2):
            if any(w[j : j + k] == w[i - k + 1 : i + 1] for j in range(len(w) - k + 1) if j != i - k + 1):
                best = k
        out.append(best)
    return out


def test_automaton_against_brute_force():
    source = random.Random(4)
    for _ in range(800):
        w = [source.choice("abcdefgh"[: source.randint(1, 8)]) for _ in range(source.randint(0, 16))]
        assert spam.repeats(w).tolist() == _longest_repeats(w)


def test_stuffed_pages(frame):
    prose = "The tram stop was closed because of the works, and nobody had been told about it. "
    keyword = "buy tram stop Xburg, cheap tram stop, best tram stop Ytown, price tram stop\n" * 10
    cases = [prose * 5, keyword, "https://a.example/x-y\n" * 20, "#buyTram #cheapTramXburg #bestTram " * 10, prose * 5 + "\nhttps://a.example/x", "- tram stop, Ab/Cd\n- ring road, Ef/Gh\n" * 3, None, "", "buy", keyword + prose * 20]
    assert {r.doc_id for r in spam.stuffed(spam.measure(frame(list(enumerate(cases)), DOC))).collect()} == {1, 2, 3}


# --- all: nulls anywhere, empty tables, clashing columns ---


def _everything(spark, frame, docs):
    """Every operator on docs, each result collected."""
    text_rows = docs.select(F.col("doc_id").cast("string").alias("id"), "text", F.col("lang").alias("label"))
    model = langid.fit(text_rows)
    rules = subjects.fit(docs, frame([(1, "a"), (None, "a"), (1, None)], "doc_id long, subject string"), ["a", "b"])
    items = frame([(1, "some item"), (None, "x"), (2, None)], "item_id long, text string")
    keyed = boilerplate.boilerplate(docs)
    results = [
        langid.segments(text_rows, model),
        keyed,
        boilerplate.without_lines(docs, keyed),
        subjects.assigned(subjects.scores(docs, rules)),
        textstats.statistics(textstats.sums(docs, chunk_chars=50)),
        tokens.encode(docs),
        leak.phrases(leak.build_index(docs), items),
        leak.near_matches(leak.build_index(docs), items),
        spam.stuffed(spam.measure(docs)),
        frequent.frequent_items(docs, {"site": (F.col("site"), "0.5")}),
        seen.answers(seen.arrivals(docs.select(F.lit("s").alias("stream"), F.col("doc_id").alias("id"), F.lit(0).alias("pos"), F.col("site").alias("key")), frame([("s", None)], "stream string, key string"))),
        cutoff.kept_records(cutoff.valid_records(docs, F.col("doc_id"), F.col("site"), F.col("score")), cutoff.cutoffs(cutoff.valid_records(docs, F.col("doc_id"), F.col("site"), F.col("score")), frame([("*", None)], "source string, keep_pct long"))),
    ]
    return [r.collect() for r in results]


CLASH = "doc_id long, text string, lang string, site string, day date, score double, line string, n long, salt int, source string, words string, units string, k1 long, cluster long"


def test_nulls_in_every_column_and_repeated_rows(spark, frame):
    row = (1, "Some text is here, and it was read by all of them.", "en", "s", date(2024, 1, 1), 0.5, "x", 1, 1, "x", "x", "x", 1, 1)
    rows = [row, row] + [tuple(None if i == k else v for i, v in enumerate(row)) for k in range(len(row))] + [(None,) * len(row), (2, "", *row[2:]), (3, "long " * 5000, *row[2:])]
    results = _everything(spark, frame, frame(rows, CLASH, 3))
    assert len(results[5]) == len(rows)  # every row is encoded


def test_empty_tables(spark, frame):
    assert all(r == [] for r in _everything(spark, frame, frame([], CLASH)))


def test_long_units_and_huge_documents_count_as_one(frame):
    # one unit far beyond any chunk, and documents of more than one default chunk
    unit = "word and more words without an end " * 2500
    texts = [unit, "A first one was here. " + unit + "\nlast", "x" * 70_000, ("The stop was closed, and nobody knew why. " * 2000) + unit]
    assert all(len(t) > textstats.CHUNK_CHARS for t in texts)
    for size in (8000, textstats.CHUNK_CHARS):
        got = {r.doc_id: [r[c] for c in textstats.SUMS] for r in textstats.sums(frame(list(enumerate(texts)), DOC), chunk_chars=size).collect()}
        assert got == {i: textstats.count(t) for i, t in enumerate(texts)}


def test_stretches_find_what_one_automaton_finds():
    source = random.Random(21)
    for _ in range(300):
        w = [source.choice("abcdefghijklmnopqrst"[: source.randint(2, 20)]) for _ in range(source.randint(0, 60))]
        for run in (1, 2, 3, 5):
            whole = spam.covered(w, run, 10**6).tolist()
            assert spam.covered(w, run, 7).tolist() == whole == spam.covered(w, run, 13).tolist()


def test_republished_articles_are_not_boilerplate(frame, rows):
    article = "line one of the article\nline two"
    docs = [(i, "s", date(2024, 1, 1 + i), article) for i in range(6)]
    docs += [(10 + i, "s", date(2024, 2, 1 + i), f"own text {'x' * (i + 1)}\nShare this now {i}") for i in range(5)]
    docs += [(20 + i, "t", date(2024, 2, 1), f"own text {'x' * (i + 1)}\nShare this now {i}") for i in range(5)]  # all of one day
    df = frame(docs, "doc_id long, site string, day date, text string")
    assert len(rows(boilerplate.boilerplate(df))) == 12 + 10
    assert rows(boilerplate.boilerplate(df, min_clusters=5, min_days=2)) == sorted([(10 + i, 1) for i in range(5)], key=str)
    report = rows(boilerplate.line_report(df), "site", "line", "docs", "clusters", "days")
    assert report == [("s", "line one of the article", 6, 1, 6), ("s", "line two", 6, 1, 6), ("s", "share this now 0", 5, 5, 5), ("t", "share this now 0", 5, 5, 1)]


def test_shards_follow_the_number_of_keys():
    assert seen.shards_for(0) == 1 and seen.shards_for(seen.SHARD_KEYS + 1) == 2 and seen.shards_for(10, 6) == 6 and seen.shards_for(10**9) == 250


def test_only_doubtful_keys_are_checked(frame):
    events = [("s", i, 0, f"k{i}") for i in range(5000)] + [("s", 6000 + i, 0, f"k{i}") for i in range(100)]
    arrived = seen.arrivals(frame(events, "stream string, id long, pos long, key string", 4), frame([("s", f"old{i}") for i in range(50)], "stream string, key string"))
    status = dict(arrived.rows.groupBy("status").count().collect())
    assert status[seen.MAYBE] + status.get(seen.REPEAT, 0) in range(100, 110)
    # 1 % of the other new keys may pass for doubtful ones
    assert status[seen.EVIDENCE] in range(status[seen.MAYBE] - 9, status[seen.MAYBE] + 100) and status[seen.NEW] > 4700


# --- lexicon ---


def _made_up_language(seed, letters):
    source = random.Random(seed)
    word = lambda: "".join(source.choice(letters) for _ in range(source.randint(3, 7)))
    joints, verbs, things, sales = ([word() for _ in range(n)] for n in (25, 60, 40, 6))
    name = lambda: word().title()

    def sentence():
        body = []
        for _ in range(source.randint(3, 5)):
            body += [source.choice(joints), source.choice(things), source.choice(verbs), source.choice(joints), name()]
        return " ".join(body).capitalize() + "."

    prose = lambda: " ".join(sentence() for _ in range(source.randint(6, 12)))
    table = lambda: "\n".join(f"- {source.choice(things)}, {name()}" + "." * source.randint(0, 1) for _ in range(30))
    keywords = lambda: "\n".join(" ".join(f"{source.choice(sales)} {source.choice(things[:3])}," for _ in range(4)) for _ in range(12))
    return prose, table, keywords


@pytest.mark.parametrize("lang, letters", [("fi", "aeiouyäöklmnprstvhj"), ("ru", "аеиоуыябвгдклмнпрст")])
def test_sentences_and_keyword_pages_of_languages_without_a_list(frame, lang, letters):
    from corpusmill.llm import lexicon

    prose, table, keywords = _made_up_language(5, letters)
    known = [(i, prose(), lang) for i in range(80)] + [(100 + i, prose() + "\n" + table(), lang) for i in range(20)] + [(200 + i, table(), lang) for i in range(10)] + [(300 + i, keywords(), lang) for i in range(12)]
    learned = lexicon.fit(frame(known + [(999, None, lang), (998, "no label here", None)], "doc_id long, text string, lang string"))
    new = [(i, prose().replace(".", "" if i % 2 else ".")) for i in range(20)] + [(100 + i, table()) for i in range(20)] + [(200 + i, keywords()) for i in range(20)]
    docs = frame(new, DOC)
    assert {r.doc_id for r in textstats.statistics(textstats.sums(docs, lexicon=learned)).where("not_prose").collect()} == {i for i, _ in new if i >= 100}
    assert {r.doc_id for r in spam.stuffed(spam.measure(docs, learned)).collect()} == {i for i, _ in new if i >= 200}
    # chunks count as the whole with a lexicon, too
    cut = {r.doc_id: [r[c] for c in textstats.SUMS] for r in textstats.sums(docs, chunk_chars=100, lexicon=learned).collect()}
    assert cut == {i: textstats.count(t, learned) for i, t in new}


def test_lexicon_of_nothing(frame):
    from corpusmill.llm import lexicon

    for rows_ in ([], [(1, None, "en"), (2, "a text", None), (None, "Another text was here.", "en"), (3, "", "xx")]):
        assert lexicon.fit(frame(rows_, "doc_id long, text string, lang string")) == lexicon.Lexicon(frozenset(), frozenset())


def _lexicon_by_brute_force(docs):
    """The lexicon of (doc_id, text, lang) rows, counted one document after the other."""
    from corpusmill.llm import lexicon

    odds = None
    for _ in range(2):
        sentences, others, in_docs = Counter(), Counter(), Counter()
        for _, text, lang in docs:
            here = set()
            for unit in set(units.units_of(text)):
                words = units.tokens_of(unit)
                if odds is None:
                    told = (len(words) > 5 or None) if units.ends_with_stop(unit) else False
                else:
                    mean = sum(odds.get(w, 0) for w in words) / len(words) if words else 0
                    told = True if len(words) >= 5 and mean > 0.5 else False if len(words) < 5 or mean < 0 else None
                if words and told is not None:
                    (sentences if told else others).update((lang, w) for w in {"", *words})
                    here.update((lang, w) for w in {"", *words})
            in_docs.update(here)
        n, a, expected, share = Counter(), Counter(), Counter(), Counter()
        for lang, w in in_docs:
            both = sentences[lang, w] + others[lang, w]
            n[w], a[w] = n[w] + both, a[w] + sentences[lang, w]
            expected[w] += both * sentences[lang, ""] / (sentences[lang, ""] + others[lang, ""])
            share[w] = max(share[w], in_docs[lang, w] / in_docs[lang, ""])
        odds = {w: max(-3, min(3, math.log((a[w] + 1) / (expected[w] + 1)) - math.log((n[w] - a[w] + 1) / (n[w] - expected[w] + 1)))) for w in n if w and n[w] >= 5}
    clause = frozenset(w for w in odds if odds[w] >= 1.3 and share[w] >= 0.06)
    bare, other = Counter(), Counter()
    for _, text, lang in docs:
        parts = units.units_of(text)
        plain = [units.judge(u, lexicon.Lexicon(clause, frozenset()))[0] != units.SENTENCE for u in parts]
        words = [(w, p) for u, p in zip(parts, plain) for w in units.tokens_of(u)]
        outside = sum(p for _, p in words)
        repeated = [w for (w, p), c in zip(words, spam.covered([w for w, _ in words])) if p and c]
        if outside >= 10 and sum(len(u) for u, p in zip(parts, plain) if p) > 0.5 * sum(map(len, parts)) and len(repeated) >= 0.25 * outside:
            bare.update((lang, w) for w in {"", *repeated})
        else:
            other.update((lang, w) for w in {"", *(w for w, _ in words)})
    share = {(lang, w): k / bare[lang, ""] for (lang, w), k in bare.items() if w and k >= 3}
    selling = {w for (lang, w), x in share.items() if x >= 0.08 and x >= 8 * other[lang, w] / max(other[lang, ""], 1)}
    return lexicon.Lexicon(clause, frozenset(w for w in selling if w.isalpha() and len(w) > 1) - clause)


@pytest.mark.parametrize("block_words", [5000, 10**9])
def test_lexicon_counts_every_document(frame, block_words):
    from corpusmill.llm import lexicon

    docs = []
    for seed, lang, letters in ((5, "fi", "aeiouyäöklmnprstvhj"), (6, "ru", "аеиоуыябвгдклмнпрст")):
        prose, table, keywords = _made_up_language(seed, letters)
        rare = lambda i: " Ja " + prose().lower() if i % 15 == 0 else ""  # noqa: B023, E731  a word near the least share
        texts = [prose() + rare(i) for i in range(640)] + [prose() + "\n" + table() for _ in range(20)] + [table() for _ in range(10)]
        texts += ["\n".join(keywords() for _ in range(40)) for _ in range(4)]  # beyond 20,000 characters
        docs += [(len(docs) + i, t, lang) for i, t in enumerate(texts)]
    assert max(len(t) for _, t, _ in docs) > 20_000
    expected = _lexicon_by_brute_force(docs)
    assert expected.clause and expected.selling
    assert lexicon.fit(frame(docs, "doc_id long, text string, lang string"), block_words=block_words) == expected


ODD_UNITS = ["see https://a.b/c and then the best of the lot was that", "#buyCheapThings", "SKU-12 and the best of it", "的了不，是在。", "- one of the items is this", "and/or", "xkcd bcdfg hjklmnp", "", "....", "buy cheap buy cheap buy cheap buy cheap", "The cat is on the mat and the dog was at the door.", "1) buy the best of the best and the rest of the best"]


def test_pages_of_blocks_equal_pages_of_texts(frame):
    from corpusmill.llm import blocks, lexicon

    source = random.Random(8)
    texts = ["\n".join(source.choice(ODD_UNITS) for _ in range(source.randint(0, 12))) for _ in range(300)]
    docs = frame([(i, t, "en" if i % 3 else None) for i, t in enumerate(texts)] + [(None, "buy cheap buy cheap", "EN-gb"), (7, "", "en"), (8, None, "en")], "doc_id long, text string, lang string")
    known = lexicon.Lexicon(frozenset("the of and is was that on at 的 是".split()), frozenset(["buy", "cheap", "best"]))
    for words_ in (1, 40, 10**6):
        got, want = (sorted(map(tuple, df.collect()), key=str) for df in (spam.measure_blocks(blocks.read(docs, block_words=words_), known), spam.measure(docs, known)))
        assert [r[:2] for r in got] == [r[:2] for r in want] and len(got) == 302
        assert all(a == pytest.approx(b) for x, y in zip(got, want) for a, b in zip(x[2:], y[2:]))


@pytest.mark.parametrize("chunk_chars", [60, 1 << 16])
def test_sums_of_blocks_equal_sums_of_texts(frame, rows, chunk_chars):
    from corpusmill.llm import blocks, lexicon

    source = random.Random(9)
    texts = [source.choice("\n ").join(source.choice(ODD_UNITS) for _ in range(source.randint(0, 12))) for _ in range(200)]
    docs = frame([(i, t, "en" if i % 3 else None) for i, t in enumerate(texts)] + [(None, "buy cheap buy cheap", "en"), (998, "", "en"), (999, None, "en")], "doc_id long, text string, lang string")
    known = lexicon.Lexicon(frozenset("the of and is was that on at 的 是".split()), frozenset(["buy", "cheap", "best"]))
    table = blocks.read(docs, block_words=40, of_text=textstats.count_text)
    expected = sorted([(i, *textstats.count(t, known)) for i, t in [*enumerate(texts), (998, "")]], key=str)
    assert rows(textstats.sums(docs, chunk_chars, known, table)) == expected


def test_rare_languages_are_learned_and_wrong_labels_are_not():
    source = random.Random(31)
    counts, docs = {}, {}
    for lang, words, n in (("en", WORDS["en"], 4000), ("de", WORDS["de"], 3000), ("fr", WORDS["fr"], 60)):
        counts[lang] = {w: n // 10 + source.randrange(9) for w in words}
        docs[lang] = {w: 4 for w in words}
    # a label that stands on English and German texts only, with names of their own
    counts["xx"] = {w: 5 + source.randrange(9) for w in WORDS["en"] + WORDS["de"]} | {f"name{i}": 9 for i in range(40)}
    docs["xx"] = {w: 3 for w in WORDS["en"] + WORDS["de"]} | {f"name{i}": 1 for i in range(40)}
    assert langid.LanguageModel.fit(counts, docs).languages == ["de", "en", "fr"]


def test_unreadable_texts_have_no_language(frame, language_model):
    source = random.Random(41)
    line = " ".join(source.choice(WORDS["en"]) for _ in range(8))
    glued = " ".join(f"{source.choice(WORDS['en'])}¼the½" for _ in range(60))
    cases = [("a", "\n".join([glued] * 5)), ("b", line + "\n" + "\n".join(["%7>]/^<6>-^~[]/=%1~|>253.^$.~8:{40x-1~"] * 30)), ("c", line + "\n" + line + "\nBrand™ name\n" + "50€"), ("d", line + "\n" + glued[:40])]
    got = {(r.id, r.seg_no): r.lang for r in langid.segments(frame(cases, "id string, text string"), language_model).collect()}
    assert got == {("c", -1): "en", ("d", -1): "en"}
