"""Token counts of whole texts by a public tokenizer."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyed.llm.common import per_text, ready, replace_columns
from keyed.llm.tokens import encoder

#: Characters of the texts that are encoded together.
LOT_CHARS = 1 << 20


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 512, text: str = "text") -> DataFrame:
    """Adds ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more tokens than ``limit``) to every row.

    The counts are those of the library for the whole text, without added special tokens, truncation or padding. Texts
    reach Python in Arrow batches, are grouped into lots of about the same number of characters and are split at safe
    boundaries; only the counts come back. No shuffle. A null or empty text has 0 bytes and 0 tokens. Rows stay as they
    are otherwise: copies, null ids and extra columns are kept; columns named like a result give way to it.
    """
    ready(docs.sparkSession)

    def counts(texts: list[str | None]) -> pa.Array:
        found, lot, size = [], [], 0
        known = encoder(tokenizer)
        for t in [*texts, None]:
            if size and size + len(t or "") > LOT_CHARS:
                found += [len(ids) // 4 for ids in known.encode(lot)]
                lot, size = [], 0
            lot.append(t)
            size += len(t or "")
        found += [len(ids) // 4 for ids in known.encode(lot)]
        return pa.array(found[: len(texts)], pa.int64())

    n = "__n_tokens"
    new = {"n_bytes": F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long"), n: per_text(counts, "long", text)}
    counted = replace_columns(docs, new)
    return replace_columns(counted, {"n_tokens": F.col(n), "over_limit": F.col(n) > limit}).drop(n)
