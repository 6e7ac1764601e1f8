import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

pytest.importorskip("corpusmill.llm")
from corpusmill.llm import langid, leak, seen, spam, textstats, units  # noqa: E402

TEXT = st.text(alphabet=st.sampled_from("abe Tc.?!\n\r\t'é中。;|#/0-»\""), max_size=400)


@settings(max_examples=300, deadline=None)
@given(TEXT, st.integers(1, 60), st.integers(1, 4))
def test_chunks_count_as_the_whole(text, size, group):
    states = [textstats.chunk_state(text[i : i + size]) for i in range(0, len(text), size)] or [textstats.chunk_state("")]
    while len(states) > 1:
        merged = []
        for i in range(0, len(states), group + 1):
            out = states[i]
            for s in states[i + 1 : i + group + 1]:
                out = textstats.merge(out, s)
            merged.append(out)
        states = merged
    assert textstats.finish(states[0]) == textstats.count(text)


@settings(max_examples=200, deadline=None)
@given(TEXT)
def test_units_cover_the_text_and_have_a_kind(text):
    parts = units.units_of(text)
    assert all(0 <= units.kind_of(u) < len(units.KINDS) for u in parts)
    assert [c for u in parts for c in u if c.isalnum()] == [c for c in text if c.isalnum()]
    chars, covered, bare, share = spam.page(text)
    assert chars == len(text) and 0 <= covered <= 1.0001 and 0 <= bare <= 1.0001 and 0 <= share <= 1.0001


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=40), st.integers(1, 4))
def test_covered_words_are_those_of_repeated_runs(words, run):
    runs = [tuple(words[i : i + run]) for i in range(len(words) - run + 1)]
    expected = [any(runs.count(runs[j]) > 1 for j in range(max(0, i - run + 1), min(len(runs), i + 1))) for i in range(len(words))]
    assert spam.covered(words, run).tolist() == expected


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=200))
def test_words_are_lower_case_letters_and_digits(text):
    assert all(w and "_" not in w for w in leak.words_of(text))


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 2**63 - 1), min_size=1, max_size=300), st.integers(1, 50))
def test_a_chain_finds_all_that_was_added(keys, capacity):
    import numpy as np

    chain = seen.BloomChain(0.01, capacity)
    h = np.array(keys, np.uint64)
    chain.add(h, h[::-1].copy())
    assert chain.maybe(h, h[::-1].copy()).all()


def test_an_unknown_word_falls_back_to_its_grams():
    model = langid.LanguageModel.fit({"en": {"walking": 50, "talking": 50}, "de": {"gehen": 50, "sehen": 50}})
    assert model.languages == ["de", "en"]
    assert model.score("stalking").argmax() == 1 and model.score("stehen").argmax() == 0 and not model.score("qqqq").any()
