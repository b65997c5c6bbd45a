from __future__ import annotations

import pytest

FIELDS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use inside.
CLASHING = "fp long, key string, doc long, owner long, h1 long, n long, size long, slot long, tid string, ids string, score double"


@pytest.fixture
def documents(spark):
    """Documents from ``(doc_id, text)`` or ``(doc_id, text, lang)``, with columns that clash if asked for."""

    def build(rows, clash=False):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None) for r in rows]
        if not clash:
            return spark.createDataFrame(full, FIELDS)
        return spark.createDataFrame([(*r, *[None] * 11) for r in full], f"{FIELDS}, {CLASHING}")

    return build
