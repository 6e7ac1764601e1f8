from hypothesis import given, settings
from hypothesis import strategies as st

from corpusmill.operators import quality, segment
from corpusmill.scratch import materialize, shared_dir

TEXT = st.text(alphabet=st.sampled_from("ab Tc.?!\n\t'é中-"), max_size=300)


@settings(max_examples=200, deadline=None)
@given(TEXT, st.integers(1, 8), st.integers(8, 20))
def test_segments_keep_every_word(text, low, high):
    assert " ".join(segment.segments(text, low, high)).split() == text.split()


@settings(max_examples=200, deadline=None)
@given(TEXT)
def test_sentences_keep_every_word(text):
    assert " ".join(segment.sentences(text)).split() == text.split()


@settings(max_examples=200, deadline=None)
@given(TEXT)
def test_repetition_shares_are_shares(text):
    assert all(0 <= x <= 1 or (name.startswith("top") and x >= 0) for name, x in zip(quality.REPETITION[1:], quality.repetition_shares(text)))


def test_materialized_tables_keep_rows_and_types(frame, rows):
    df = frame([(1, None, [1, None]), (2, "", None)], "i long, t string, a array<int>")
    back = materialize(df, "test")
    assert back.schema == df.schema and rows(back) == rows(df)


def test_shared_folder_is_the_session_s(spark):
    assert shared_dir(spark) == shared_dir(spark) != ""
