import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Builds a documents table from ``{id: text}`` or ``[(id, text)]``, with columns whose names
    operators also use inside."""

    def build(rows, extra=False):
        rows = list(rows.items()) if isinstance(rows, dict) else rows
        kind = DOCUMENTS + (", row string, d long, places string, k1 long, component long" if extra else "")
        more = ("x", 1, "y", 2, 3) if extra else ()
        data = [(i, t, "en", "s", len(t) if t is not None else None, *more) for i, t in rows]
        return spark.createDataFrame(data, kind)

    return build


def pseudo_words(n, seed, vocabulary=4000):
    """``n`` words by a fixed rule."""
    out, x = [], seed * 7919 + 17
    for _ in range(n):
        x = (x * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        out.append(f"w{(x >> 33) % vocabulary}")
    return out
