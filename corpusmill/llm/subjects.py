"""Subject areas of documents, by class-association rules.

Rules "these words in a unit -> this subject" are mined with parallel
FP-growth from the units (sentences, items, cells, keywords, tags) of a bounded
sample of labelled documents. Their confidence is balanced, as if all subjects
were equally frequent, so that phrases which go with any subject don't speak
for the commonest one; a rule goes if a more general one is as sure. The first
rules then label the sample and a bounded sample of unlabelled documents, and
those clearly about one subject are mined once more, so that words of rarely
labelled languages are learned too. The sample stays in a table: counting,
choosing words, balancing and self-labelling run on the executors, and only
the rules that hold reach the driver.
A part of the labelled documents is held out of the mining and calibrates the
evidence: how often units of some evidence are about a subject of their
document tells what evidence is enough.
Every unit of every document is scored by the evidence of the rules that it
matches; a document has the subjects that at least SHARE of its judged units,
those with a subject, are about.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import units
from corpusmill.llm.langid import primary_label
from corpusmill.scratch import materialize

#: Bounds of the fit: labelled and unlabelled documents of the samples, and their longest text.
LABELLED_DOCS, OTHER_DOCS, SAMPLE_CHARS = 2500, 1000, 8_000
#: One of so many labelled documents is held out for calibration.
HELD_OUT = 6
#: A unit of so many characters with RUN_PARTS parts of RUN_MEAN characters at most between its separators is cut there.
RUN_CHARS, RUN_PARTS, RUN_MEAN = 60, 4, 45
#: Words of a unit that enter mining: its most telling ones. FP-growth is exponential in this number only.
UNIT_WORDS = 4
#: A word enters mining if it stands in so many documents, and words and rules must be so many times as frequent
#: with one subject as with any other.
WORD_DOCS, TIMES = 3, 2.0
#: Documents added to each subject and language, so that a few wrong labels weigh little, and the units they stand for.
SMOOTH, UNITS_A_DOC = 3.0, 10
#: Units a rule must hold for, its least balanced confidence after shrinking by PRIOR units of no subject,
#: and how much surer than a more general rule it must be.
RULE_UNITS, CONFIDENCE, PRIOR, GAIN = 3, 0.6, 1.5, 0.05
#: Share of its judged units and number of them from which a document counts as clearly about one subject.
CLEAR, CLEAR_UNITS = 0.8, 3
#: Probability from which a unit is about a subject, of that which the surest units reach; labels are partly wrong.
ABOUT = 0.7
#: Bins of evidence in the calibration: width, lowest and number; units that the assumed probability counts for in each.
BIN, LOWEST, BINS, ASSUMED = 0.25, -2.0, 40, 20.0
#: Share of the judged units a subject needs; if fewer than FEW of all units are judged, most must not be junk.
SHARE, FEW = 1 / 3, 0.2
MIN_CHARS = 30

_ALNUM = re.compile(r"[^\W_]")
_HAN_RUN = re.compile(r"[㐀-䶿一-鿿]{2,}")
#: What parts the keywords, tags and links of a page that are run together in one unit.
_RUN = re.compile(r"\s[-–/·]\s|[,»]\s|>>|\s{2,}|\s(?=#)|\s(?=\[)|\s(?=https?://)")
_RUN_MARKS = ("-", "–", "/", "·", ",", "»", ">>", "  ", "#", "[", "\xa0", "\r")
_CUT = "doc_id long, unit long, lang string, items array<string>"
_SCORES = "doc_id long, subject string, about long, judged long, units long, chars long, confidence double"


def items_of(unit: str) -> set[str]:
    """What a unit can match: its words of two letters and more in lower case, and its Han bigrams."""
    if "#" in unit:
        unit = units.CAMEL.sub(" ", unit)
    unit = unit.lower()
    found = {w for w in units.WORD.findall(unit) if len(w) > 1 and w[0] < "㐀"}
    if unit and max(unit) >= "㐀":
        for run in _HAN_RUN.findall(unit):
            found.update(run[i : i + 2] for i in range(len(run) - 1))
    return found


def parts_of(text: str) -> list[str]:
    """The units of a text, with keywords, tags and links that are run together in one unit apart."""
    out = []
    for unit in units.units_of(text):
        # counting what separators are made of is much cheaper than looking for them
        if len(unit) >= RUN_CHARS and sum(map(unit.count, _RUN_MARKS)) >= RUN_PARTS - 1:
            pieces = _RUN.split(unit)
            if RUN_PARTS <= len(pieces) and len(unit) <= RUN_MEAN * len(pieces):
                out += [p for p in pieces if _ALNUM.search(p)]
                continue
        out.append(unit)
    return out


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, numbers, langs, found = [], [], [], []
        for doc_id, text, lang in zip(*(batch.column(c).to_pylist() for c in range(3))):
            for n, unit in enumerate(parts_of(text or "")):
                items = items_of(unit)
                if items:
                    ids.append(doc_id)
                    numbers.append(n)
                    langs.append(lang)
                    found.append(sorted(items))
        columns = [pa.array(ids, pa.int64()), pa.array(numbers, pa.int64()), pa.array(langs, pa.string()), pa.array(found, pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "unit", "lang", "items"])


@dataclass
class RuleModel:
    """Rules by one of their words, and what their evidence is worth."""

    subjects: list[str]
    #: first word -> [(other words, subject number, log-odds evidence)]
    rules: dict[str, list[tuple[frozenset, int, float]]]
    #: calibrated probability by bin of evidence, rising; None for the assumed one
    worth: list[float] | None = None

    def __post_init__(self) -> None:
        self._words = frozenset(w for first, rules in self.rules.items() for rest, _, _ in rules for w in (first, *rest))
        self._even = math.log(max(len(self.subjects) - 1, 1))
        worth = self.worth or [assumed(k) for k in range(BINS)]
        top = max(worth)
        self._worth = [p / top for p in worth]

    def subject_of(self, unit: str) -> int:
        """Number of the subject that a unit is about, or -1."""
        return self.judge(items_of(unit))

    def judge(self, items: set[str] | frozenset[str]) -> int:
        """Number of the subject that a unit with these items is about, or -1."""
        subject, evidence = self.best(items)
        return subject if subject >= 0 and self._worth[bin_of(evidence)] >= ABOUT else -1

    def best(self, items: set[str] | frozenset[str]) -> tuple[int, float]:
        """(subject number, evidence) of the subject that the rules speak most clearly for; -1 if none or two alike."""
        known = self._words.intersection(items)
        return self._best(known) if known else (-1, 0.0)

    def _best(self, items: frozenset[str]) -> tuple[int, float]:
        best: dict[int, dict[int, float]] = {}
        for word in items:
            for rest, subject, weight in self.rules.get(word, ()):
                if rest <= items:
                    per_size = best.setdefault(subject, {})
                    key = len(rest)
                    per_size[key] = per_size.get(key, 0.0) + weight
        if not best:
            return -1, 0.0
        # longer rules repeat the words of shorter ones: only the strongest length counts
        scored = sorted(((max(x.values()) - self._even, s) for s, x in best.items()), reverse=True)
        if len(scored) > 1 and scored[0][0] - scored[1][0] < 0.2:
            return -1, 0.0
        return scored[0][1], scored[0][0]

    def count(self, text: str) -> tuple[dict[int, list], list[str]]:
        """([units, sum of their probabilities] by subject number; the units) of a text."""
        if "#" in text:
            text = units.CAMEL.sub(" ", text)
        parts = parts_of(text)
        counts: dict[int, list] = {}
        known, best, words, han, worth = self._words.intersection, self._best, units.WORD.findall, not text.isascii(), self._worth
        for unit in parts:
            found = known(items_of(unit) if han else words(unit.lower()))
            if found:
                subject, evidence = best(found)
                p = worth[bin_of(evidence)] if subject >= 0 else 0.0
                if p >= ABOUT:
                    slot = counts.setdefault(subject, [0, 0.0])
                    slot[0] += 1
                    slot[1] += p
        return counts, parts


def bin_of(evidence: float) -> int:
    """Bin of the calibration for an evidence in nats."""
    return min(max(int((evidence - LOWEST) // BIN), 0), BINS - 1)


def assumed(k: int) -> float:
    """Probability that a bin's evidence stands for if it is taken as log-odds."""
    return 1 / (1 + math.exp(-(LOWEST + k * BIN)))


def calibrated(seen: dict[int, tuple[int, int]]) -> list[float]:
    """Rising probabilities by bin from bin -> (units, right ones), by pooling bins that fall.

    ASSUMED units of the assumed probability, scaled to the share that is
    right among the surest half of all units, stand in every bin, so that empty bins have a value.
    """
    n = sum(x for x, _ in seen.values())
    upper, ceiling, right = 0, 0, 0
    for k in sorted(seen, reverse=True):
        if 2 * upper < n:
            upper, right = upper + seen[k][0], right + seen[k][1]
    ceiling = (right + ASSUMED) / (upper + ASSUMED)
    blocks: list[list[float]] = []
    for k in range(BINS):
        units_, good = seen.get(k, (0, 0))
        blocks.append([good + ASSUMED * ceiling * assumed(k), units_ + ASSUMED, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] > blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return [b[0] / b[1] for b in blocks for _ in range(int(b[2]))]


def unreadable(parts: list[str]) -> bool:
    """True if most characters stand in units of symbols or of words without vowels; figures are readable."""
    junk = total = 0
    for u in parts:
        bare = u.replace(" ", "")
        total += len(bare)
        if units.kind_of(u) == units.JUNK:
            words = units.WORD.findall(u.lower())
            junk += len(bare) * (len(_ALNUM.findall(u)) < 0.6 * len(bare) or bool(words) and units.unreadable(words, sum(map(len, words))))
    return 2 * junk > total


def _score(model: RuleModel):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text, chars, drop in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if drop:
                    gone = set(drop)
                    text = "\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone)
                counts, parts = model.count(text)
                judged = sum(n for n, _ in counts.values())
                if not judged or judged < FEW * len(parts) and unreadable(parts):
                    continue
                out += [(doc_id, model.subjects[s], n, judged, len(parts), chars, p / n) for s, (n, p) in counts.items()]
            types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
            columns = zip(*out) if out else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "subject", "about", "judged", "units", "chars", "confidence"])

    return score


def scores(docs: DataFrame, model: RuleModel) -> DataFrame:
    """(doc_id, subject, about, judged, units, chars, confidence): how many units of a document are about each subject.

    docs: (doc_id, text), and drop, numbers of lines to leave aside, if there
    is such a column of arrays. confidence is the mean calibrated probability of those units.
    Null texts and texts without a judged unit have no rows; nothing is shuffled.
    """
    drop = F.col("drop") if "drop" in docs.columns and docs.schema["drop"].dataType.typeName() == "array" else F.lit(None).cast("array<int>").alias("drop")
    return docs.select("doc_id", "text", F.length("text").cast("long").alias("chars"), drop).where(F.col("text").isNotNull()).mapInArrow(_score(model), _SCORES)


def assigned(scored: DataFrame, share: float = SHARE) -> DataFrame:
    """The rows of scored whose subject takes at least share of the judged units of a document of MIN_CHARS characters."""
    return scored.where((F.col("chars") >= MIN_CHARS) & (F.col("about") >= share * F.col("judged") - 1e-9))


def _telling_words(words: dict[tuple[int, str], set[str]], labels: dict[int, list[str]]) -> dict[str, tuple[float, str]]:
    """Word -> (worth, main language) of the words that speak for one subject.

    words: of each document and language. They are counted by document, and in
    their main language only, since the subjects are mixed differently in every language.
    """
    docs: Counter = Counter((lang, s) for doc, lang in words for s in labels[doc])
    found: dict[str, dict[str, Counter]] = defaultdict(lambda: defaultdict(Counter))
    for (doc, lang), items in words.items():
        for w in items:
            found[w][lang].update(labels[doc])
    out = {}
    for w, by_lang in found.items():
        n, lang = max((sum(c.values()), x) for x, c in by_lang.items())
        if n >= WORD_DOCS:
            rates = sorted((k / (docs[lang, s] + SMOOTH) for s, k in by_lang[lang].items()), reverse=True)
            if len(rates) == 1 or rates[0] >= TIMES * rates[1]:
                out[w] = rates[0] / (sum(rates) + SMOOTH / 100), lang
    return out


def _to_transactions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, labels, items) of all units (doc_id, lang, items, labels) of the bounded sample.

    items: the most telling words of a unit, each behind its language, and its
    document's subjects behind '='.
    """
    units_: list[tuple] = []
    labels: dict[int, list[str]] = {}
    words: dict[tuple[int, str], set[str]] = defaultdict(set)
    for batch in batches:
        for doc, lang, items, given in zip(*(batch.column(c).to_pylist() for c in range(4))):
            labels[doc] = given
            words[doc, lang].update(items)
            units_.append((doc, lang, items))
    telling = _telling_words(words, labels)
    rows = set()  # what a document repeats counts once
    for doc, lang, items in units_:
        best = sorted(telling.keys() & set(items), key=lambda w: (-telling[w][0], w))[:UNIT_WORDS]
        if best:
            rows.add((doc, lang, tuple(best)))
    found = [(lang, labels[doc], [*(f"{telling[w][1]} {w}" for w in best), *(f"={s}" for s in labels[doc])]) for doc, lang, best in sorted(rows, key=str)]
    for at in range(0, max(len(found), 1), 2000):
        columns = list(zip(*found[at : at + 2000])) or [[]] * 3
        types = (pa.string(), pa.list_(pa.string()), pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["lang", "labels", "items"])


def _mine(sample: DataFrame, labels: DataFrame, subjects: list[str]) -> RuleModel:
    """Rules from the units of sample (doc_id, unit, lang, items) whose documents have labels (doc_id, labels)."""
    from pyspark.ml.fpm import FPGrowth  # not needed where units are scored

    # one task: at most LABELLED_DOCS and OTHER_DOCS texts of SAMPLE_CHARS characters
    labelled = sample.join(F.broadcast(labels), "doc_id").select("doc_id", "lang", "items", "labels").coalesce(1)
    rows = materialize(labelled.mapInArrow(_to_transactions, "lang string, labels array<string>, items array<string>"), "transactions")
    counted = rows.select("lang", F.explode("labels").alias("subject")).groupBy("lang", "subject").agg(F.count(F.lit(1)).alias("n"))
    sizes = {(r.subject, r.lang): r.n for r in counted.collect()}  # subjects x languages
    n = rows.count()
    if not n:
        return RuleModel(subjects, {})
    cores = min(rows.sparkSession.sparkContext.defaultParallelism, 16)
    found = FPGrowth(itemsCol="items", minSupport=min(1.0, RULE_UNITS / n), minConfidence=0.02).fit(rows.select("items").repartition(cores)).associationRules
    rules = found.where(F.col("consequent")[0].startswith("=") & ~F.exists("antecedent", lambda x: x.startswith("=")))
    hits = F.round(F.col("support") * n)
    rules = rules.select(F.array_sort("antecedent").alias("words"), F.substring(F.col("consequent")[0], 2, 1000).alias("subject"), hits.alias("hits"), (hits / F.col("confidence")).alias("of"))
    grouped = rules.groupBy("words").agg(F.collect_list(F.struct("subject", "hits")).alias("hits"), F.max("of").alias("of"))
    balanced = grouped.mapInArrow(_balance(subjects, sizes), "words array<string>, subject string, sure double")
    # bounded by the sample: those of its rules that hold
    return _concise([(r.words, r.subject, r.sure) for r in balanced.collect()], subjects)


def _sure(hits: dict[str, float], of: float, lang: str, present: list[str], sizes: dict[tuple[str, str], int]) -> list[tuple[str, float]]:
    """(subject, balanced confidence) of the rules of one antecedent that hold; it has so many hits by subject of all its units.

    Hits below RULE_UNITS are not mined; what the known ones leave over is spread over the rest.
    """
    known = {s: n for s, n in hits.items() if s in present}
    unknown = [s for s in present if s not in known]
    left = max(0.0, of - sum(known.values())) / len(unknown) if unknown else 0.0
    rate = {s: known.get(s, left) / (sizes.get((s, lang), 0) + SMOOTH * UNITS_A_DOC) for s in present}
    total = sum(rate.values())
    out = []
    for s, n in known.items():
        shrunk = (rate[s] / total * n + PRIOR / len(present)) / (n + PRIOR)
        if shrunk >= CONFIDENCE and rate[s] >= TIMES * max((r for x, r in rate.items() if x != s), default=0.0):
            out.append((s, min(shrunk, 0.99)))
    return out


def _balance(subjects: list[str], sizes: dict[tuple[str, str], int]):
    """An Arrow function of antecedents (words behind their languages) with their hits by subject: the rules that are sure enough once balanced.

    sizes: units labelled with each subject in each language.
    """
    present = [s for s in subjects if any(n for (x, _), n in sizes.items() if x == s)]

    def balance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for named, hits, of in zip(*(batch.column(c).to_pylist() for c in range(3))):
                langs, words = zip(*(w.split(" ", 1) for w in named))
                out += [(words, s, p) for s, p in _sure({h["subject"]: h["hits"] for h in hits}, of, langs[0], present, sizes)]
            columns = zip(*out) if out else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.list_(pa.string()), pa.string(), pa.float64()))], names=["words", "subject", "sure"])

    return balance


def _pruned(mined: list[tuple], subjects: list[str], sizes: dict[tuple[str, str], int], language: dict[str, str]) -> RuleModel:
    """As _balance and _concise, of mined rules (antecedent, subject, confidence, hits) at hand; language: that of each word."""
    present = [s for s in subjects if any(sizes.get((s, x)) for x in set(language.values()))]
    hits: dict[tuple, dict[str, float]] = defaultdict(dict)
    of: dict[tuple, float] = {}
    for words, subject, confidence, n in mined:
        key = tuple(sorted(words))
        hits[key][subject] = n
        of[key] = max(of.get(key, 0.0), n / max(confidence, 1e-9))
    return _concise([(list(key), s, p) for key in hits for s, p in _sure(hits[key], of[key], language[key[0]], present, sizes)], subjects)


def _concise(rules: list[tuple[list[str], str, float]], subjects: list[str]) -> RuleModel:
    """A model of the rules (words, subject, confidence) without those that a more general rule of their subject makes redundant."""
    sure: dict[tuple[frozenset, str], float] = {}
    kept: dict[str, list[tuple[frozenset, int, float]]] = defaultdict(list)
    even = math.log(max(len(subjects) - 1, 1))
    for words, s, p in sorted(rules, key=lambda r: (len(r[0]), sorted(r[0]), r[1])):
        general = max((sure.get((frozenset(x), s), 0.0) for k in range(1, len(words)) for x in combinations(words, k)), default=0.0)
        if p > general + GAIN:
            key = frozenset(words)
            sure[key, s] = p
            first = max(key)
            kept[first].append((key - {first}, subjects.index(s), math.log(p / (1 - p)) + even))
    return RuleModel(subjects, dict(kept))


def _judged(model: RuleModel):
    """An Arrow function of (doc_id, items): (doc_id, subject, bin, about) of the units with evidence."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, items in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                subject, evidence = model.best(frozenset(items))
                if subject >= 0:
                    out.append((doc_id, model.subjects[subject], bin_of(evidence), model.judge(frozenset(items)) >= 0))
            columns = zip(*out) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.int32(), pa.bool_()))], names=["doc_id", "subject", "bin", "about"])

    return judge


def _apply(sample: DataFrame, model: RuleModel) -> DataFrame:
    return sample.select("doc_id", "items").mapInArrow(_judged(model), "doc_id long, subject string, bin int, about boolean")


def _clear(sample: DataFrame, model: RuleModel) -> DataFrame:
    """(doc_id, labels): the one subject of each document that the model finds clearly about one."""
    counts = _apply(sample, model).where("about").groupBy("doc_id", "subject").agg(F.count(F.lit(1)).alias("n"))
    by_doc = counts.groupBy("doc_id").agg(F.sum("n").alias("all"), F.max(F.struct("n", "subject")).alias("top"))
    return by_doc.where((F.col("all") >= CLEAR_UNITS) & (F.col("top.n") >= CLEAR * F.col("all"))).select("doc_id", F.array("top.subject").alias("labels"))


def _bucket(salt: str) -> Column:
    return F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.lit(1_000_000))


def fit(docs: DataFrame, labels: DataFrame, subjects: list[str]) -> RuleModel:
    """Rules from docs (doc_id, text, lang) and labels (doc_id, subject), which may be wrong, repeated or incomplete.

    lang is the declared language; it only balances the counts, so wrong or missing ones do little harm.

    Labels are compared in lower case; those outside subjects are not used.
    """
    known = labels.select("doc_id", F.lower(F.trim("subject")).alias("subject")).where(F.col("subject").isin(subjects) & F.col("doc_id").isNotNull()).distinct()
    by_doc = known.groupBy("doc_id").agg(F.sort_array(F.collect_set("subject")).alias("labels"))
    share = min(1.0, LABELLED_DOCS / max(by_doc.count(), 1))
    given = materialize(by_doc.where(_bucket("subjects") < share * 1_000_000).withColumn("held_out", _bucket("held out") % HELD_OUT == 0), "labelled")
    other = _bucket("subjects") < min(1.0, OTHER_DOCS / max(docs.select("doc_id").count(), 1)) * 1_000_000
    lang = F.coalesce(primary_label(F.col("lang")), F.lit(""))
    rows = docs.where(F.length("text").between(MIN_CHARS, SAMPLE_CHARS)).select("doc_id", "text", lang.alias("lang")).join(given.select("doc_id", "held_out"), "doc_id", "left")
    sample = materialize(rows.where(F.col("held_out").isNotNull() | other).select("doc_id", "text", "lang").mapInArrow(_split, _CUT), "sample")
    shown = given.where("not held_out").select("doc_id", "labels")
    first = _mine(sample, shown, subjects)
    # the first rules label the whole sample: only documents clearly about one subject are mined again
    hidden = given.where("held_out").select("doc_id", "labels")
    clear = materialize(_clear(sample, first).join(hidden, "doc_id", "left_anti"), "clear")
    model = _mine(sample, clear, subjects)
    if not model.rules:
        model = first
    tried = _apply(sample, model).join(hidden, "doc_id")
    right = F.count_if(F.array_contains("labels", F.col("subject")))
    seen = {r.bin: (r.n, r.right) for r in tried.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), right.alias("right")).collect()}  # at most BINS rows
    return RuleModel(subjects, model.rules, calibrated(seen))
