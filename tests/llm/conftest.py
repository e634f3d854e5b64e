import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(frame):
    """docs(texts) -> documents numbered from 0."""
    return lambda texts: frame([(k, t, "en", "s", len(t or "")) for k, t in enumerate(texts)], DOCS)


@pytest.fixture
def odd_docs(frame):
    """NULLs in every column, empty and long texts, a repeated row, and columns whose names operators may use inside."""
    rows = [
        (0, "the cat and the dog of it \n" * 30, "en", "s", 1, 7, "a"),
        (1, None, None, None, None, None, None),
        (2, "", "en", "s", 0, 7, "b"),
        (None, "no id here but five words and more", "en", "s", 5, 7, "c"),
        (3, "word " * 30_000, "de", "s", 5, 7, "d"),
        (4, "same row, the same text twice over and over", "en", "s", 5, 7, "e"),
        (4, "same row, the same text twice over and over", "en", "s", 5, 7, "e"),
        (5, "\t\n \x0b", "en", "s", 4, 7, "f"),
    ]
    return frame(rows, "doc_id long, text string, lang string, source string, n_chars long, row int, node string")
