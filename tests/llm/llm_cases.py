"""Shared inputs of the tests of this package."""

SF_SMALL = "/root/testdata/sf0.001"

# Rows that every operator over documents must take: nulls in each column, empty
# and long texts, ties, repeated rows, columns with names that operators use.
LONG = " ".join(f"word{i}" for i in range(30_000))
SENTENCE = "one two three four five six seven eight nine ten eleven twelve"
HARD = [(1, SENTENCE, "en", "a", 5), (1, SENTENCE, "en", "a", 5), (2, SENTENCE.upper(), "en", "a", 5), (3, None, "en", "a", None), (4, "", None, None, 0),
        (None, SENTENCE, "en", None, 1), (5, LONG, None, "b", 9), (6, LONG + " end", "de", "b", 9), (7, "a", "", "", 1), (8, " \n\t\x0b ", "fr", "c", 5),
        (9, "été    x \U0001f600 <|endoftext|>", "fr", "c", 9), (10, "line\nline\n\nline\r\n", "en", "d", 4)]
