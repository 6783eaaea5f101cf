"""Explicit schemas: no reader in this package infers one."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
_T = T.TimestampType()
_STRINGS = T.ArrayType(T.StringType())

CONVERSATIONS = _struct(
    ("character_id1", _S), ("character_id2", _S), ("movie_id", _S), ("line_id_list", _S)
)
LINES = _struct(
    ("line_id", _S),
    ("character_id1", _S),
    ("movie_id", _S),
    ("character_name", _S),
    ("utterance", _S),
)
TITLES = _struct(
    ("movie_id", _S),
    ("movie_name", _S),
    ("release_year", _S),
    ("imdb_rating", _D),
    ("num_imdb_votes", _L),
    ("genre", _S),
)
CHARACTERS = _struct(
    ("character_id", _S),
    ("character_name", _S),
    ("movie_id", _S),
    ("movie_name", _S),
    ("gender", _S),
    ("position", _S),
)
DETAILS = _struct(
    ("movie_name", _S),
    ("year", _I),
    ("kind", _S),
    ("cover_url", _S),
    ("original_title", _S),
    ("localized_title", _S),
    ("genres", _S),
    ("runtimes", _S),
    ("countries", _S),
    ("language_codes", _S),
    ("rating", _D),
    ("votes", _L),
    ("imdbID", _S),
    ("plot_outline", _S),
    ("languages", _S),
    ("director", _S),
    ("writer", _S),
    ("cast", _S),
    ("character_names", _S),
    ("box_office", _S),
    ("plot", _S),
    ("synopsis", _S),
)
QA = _struct(
    ("question", _S), ("imdb_key", _S), ("answers", _STRINGS), ("correct_index", _I)
)
QA_MOVIES = _struct(("imdb_key", _S), ("name", _S), ("year", _I), ("genre", _S))
QA_DETAILS = _struct(("title", _S), ("plot_outline", _S))

CONTEXT = _struct(
    ("movie_name", _S),
    ("character_names", _S),
    ("genre", _S),
    ("year", _I),
    ("imdb_rating", _D),
    ("num_imdb_votes", _L),
    ("plot_outline", _S),
    ("additional_information", _S),
)
RECORDS = _struct(
    ("split", _S),
    ("type", _S),
    ("instruction", _S),
    ("input", _S),
    ("context", CONTEXT),
    ("response", _S),
)
MESSAGES = _struct(("conv_id", _L), ("turn", _L), ("role", _S), ("text", _S))
#: A message as it is delivered: when it was sent and when it came in.
DELIVERED = _struct(
    ("conv_id", _L), ("turn", _L), ("role", _S), ("text", _S), ("sent", _T), ("arrived", _T)
)
METRICS = _struct(("run_id", _S), ("metric", _S), ("value", _D))
