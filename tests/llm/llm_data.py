"""Fixed inputs that the tests of the training-data operators share."""

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Nulls in every column, empty and blank texts, ties, repeated rows.
ODD_ROWS = [
    (1, "one two three four five six seven", "en", "a", 33),
    (1, "one two three four five six seven", "en", "a", 33),
    (2, None, None, None, None),
    (3, "", "en", "b", 0),
    (4, " \t\n ", "en", None, 4),
    (None, "no id here but some words", None, "a", 25),
    (None, "no id here but some words", None, "a", 25),
    (None, None, None, None, None),
    (5, "ONE TWO THREE FOUR FIVE SIX SEVEN", "en", "a", 33),
    (6, "été ß 中文 \U0001f600 ÉTÉ", "fr", "c", 12),
    (7, "long " * 30_000 + "end\nlast line", "en", "b", 150_013),
    (8, "line\n\nline\n Line \r\nother", "en", "b", 24),
]
