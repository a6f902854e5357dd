"""Text to words. Everything here works within one row, so no step shuffles."""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from . import porter
from .stopwords import STOP_WORDS

LETTERS = r"\p{L}+"
NOT_BLANK = r"\S+"
NOT_LETTERS = r"[^\p{L}]"

# Python workers get these functions with the task, so the package need not be
# installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(porter)


def shrink(col: Column | str) -> Column:
    """Runs of white space become one blank, none is left at the ends."""
    return F.trim(F.regexp_replace(F.col(col) if isinstance(col, str) else col, r"\s+", " "))


def tokenize(col: Column | str, pattern: str = LETTERS) -> Column:
    """Lower-cased matches of ``pattern``, by default runs of letters, in document order."""
    return F.regexp_extract_all(F.lower(col), F.lit(pattern), F.lit(0))


def normalize(tokens: Column | str) -> Column:
    """Take all but letters out of every token; drop tokens left empty."""
    return F.filter(F.transform(tokens, lambda t: F.regexp_replace(t, NOT_LETTERS, "")), lambda t: t != "")


def remove_stop_words(
    tokens: Column | str, words: Sequence[str] = STOP_WORDS, *, lowered: bool = False
) -> Column:
    """Drop stop words, whatever their case; ``lowered`` says the tokens are in lower case."""
    stop = sorted({w.lower() for w in words})
    return F.filter(tokens, lambda t: ~(t if lowered else F.lower(t)).isin(stop))


# Stems seen lately by this task. When the first holds half of the limit, it takes the place of the second,
# whose words come back as they are seen again; so frequent words stay and rare ones go.
_SEEN: dict[str, str] = {}
_SEEN_BEFORE: dict[str, str] = {}
_SEEN_LIMIT = 1 << 18
#: Words that are looked up at a time, so that the Python objects made for them do not grow with the batch.
_SLICE = 1 << 20


def _stems(words: pa.Array) -> pa.Array:
    """Stem of every word of a flat column, computed once per distinct word of a slice, unless it was seen lately."""
    parts = [_slice_stems(words.slice(at, _SLICE)) for at in range(0, len(words), _SLICE)]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.string())


def _slice_stems(words: pa.Array) -> pa.Array:
    coded = words.dictionary_encode()
    stems = []
    for word in coded.dictionary.to_numpy(zero_copy_only=False).tolist():
        stem = _SEEN.get(word)
        if stem is None:
            if 2 * len(_SEEN) >= _SEEN_LIMIT:
                _SEEN_BEFORE.clear()
                _SEEN_BEFORE.update(_SEEN)
                _SEEN.clear()
            stem = _SEEN_BEFORE.get(word)
            _SEEN[word] = stem = porter.stem(word) if stem is None else stem
        stems.append(stem)
    return pa.array(stems, type=pa.string()).take(coded.indices)


@F.arrow_udf(ArrayType(StringType()))
def stem_tokens(tokens: pa.Array) -> pa.Array:
    """Porter stems of every token.

    The token column is only re-mapped in Arrow, and no token leaves its row,
    so nothing shuffles.
    """
    lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
    offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]), type=pa.int32())
    return pa.ListArray.from_arrays(offsets, _stems(tokens.flatten()), mask=tokens.is_null())


@F.arrow_udf(StringType())
def stem_word(words: pa.Array) -> pa.Array:
    """Porter stem of a column of words."""
    return _stems(words)
