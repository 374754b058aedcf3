"""Made texts and names shared by the tests of the text operators."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# names that an operator may use for its own columns
CLASH = ["row", "shard", "id", "_id", "_th", "pos", "h", "lines", "begins", "u", "cdf", "of", "order", "low", "letter", "t", "_w", "bucket", "keys", "ids", "head", "key"]


def prose(seed: int, n: int) -> str:
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("abdeilmnorstu") for _ in range(rnd.randint(2, 8))) for _ in range(n))


def corpus() -> list[tuple]:
    """Null, empty and odd texts, equal rows, ties, copies, near copies, shared passages, one very long text."""
    passage = prose(1, 60)
    lines = [prose(100 + k, 12) for k in range(6)]
    base = prose(2, 300).split()
    near = [base[:50] + ["changed"] + base[51:], base[:200] + ["other", "words"] + base[200:], base[3:], base[:20] + base[24:]]
    texts = [
        None, "", " \n\t ", "one", "one two", "One two", prose(3, 40), prose(3, 40), f"{prose(4, 30)} {passage} {prose(5, 50)}",
        f"{passage}\n{prose(6, 35)}", " ".join(base), *[" ".join(x) for x in near], "\n".join([prose(7, 9), *lines, prose(8, 9)]),
        "\n".join([*lines, prose(9, 9)]), "\n".join(lines[1:4]), "\n\n\n\n\n", " ".join(["again"] * 90), prose(10, 34), prose(10, 35),
        "ΑΒΓ ünï code　x " * 20, f"{prose(11, 9000)} {passage}", "x" * 3000, "### $$$ | <a> " * 12,
    ]
    rows = [(k, x, ("en", None, "fr")[k % 3], ("a", "a", None, "b")[k % 4], None if x is None else len(x)) for k, x in enumerate(texts)]
    return [*rows, rows[6], rows[6], (None, texts[6], None, None, None), (None, None, None, None, None), (5, prose(12, 50), "en", "b", 1)]


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(k) for k, c in enumerate(CLASH)})
