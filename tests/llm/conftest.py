from __future__ import annotations

import pytest

#: Every operator gets these: nulls anywhere, empty and long texts, ties, repeated rows, odd characters.
ODD_TEXTS = [
    None,
    "",
    " ",
    "\n\n",
    "a",
    "it's we'll 'tis ''s 's's x'\n're 'REd don't",
    "tabs\tand  two  blanks \r\n and\x0bvertical\x0c ",
    "Ünïcödé ÀÉ ß 漢字 かな ½ ² Ⅷ ١٢٣ é  nbsp wide",
    "🙂🙂 emoji‍ 👩‍👩‍👧  \U0010ffff \x00 nul",
    "long " * 3000,
    "x" * 5000,
    "café " * 700 + "\nend",
    "same text here\nsame line",
    "same text here\nsame line",
    "<|endoftext|> <|startoftext|>x <|endoftext|>",
    "9" * 50 + " 12 34 " * 20,
]


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Odd texts under clashing extra columns, a null id, a repeated id and a repeated row."""
    rows = [
        (i, text, ("en", "fr", None)[i % 3], None if i % 5 == 0 else f"src{i % 2}", len(text or ""), "x", i, "y")
        for i, text in enumerate(ODD_TEXTS)
    ]
    rows.append((None, "no id here", "en", "src0", 10, "x", 0, "y"))
    rows.append((3, "same id, other text", "en", "src1", 19, "x", 0, "y"))
    rows += [rows[4], rows[4]]
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string, name long, found string"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)
