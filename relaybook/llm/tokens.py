"""Token counts by the whole-token shortcut.

A tokenizer first cuts a text into pre-tokens and then merges bytes inside each. Most pre-tokens are
strings of the vocabulary; which of them really encode alone as one token is proved once, by encoding
every string of the vocabulary. Such pre-tokens count 1 without merging; only the rest are merged.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from relaybook.llm.common import map_arrow, quoted, without

LIMIT = 512
#: Counts of merged pre-tokens that a task remembers.
REMEMBERED = 500_000

#: Letters, and digits with other numbers, up to U+024F.
_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_NUMBER = "0-9²³¹¼-¾"
#: Characters whose class is the same in every version of Unicode and every regex library.
_PLAIN = re.compile("[\t\n\r\x20-\x7e¡-ɏ]*")
#: Borders between a plain character that is no white space and white space: no pre-token goes over one,
#: as white space stands at the beginning of a pre-token or makes up all of it.
_BORDER = re.compile("(?<=[\x21-\x7e¡-ɏ])(?=[\t\n\r\x20])")
#: The byte-level pre-token pattern over plain characters.
_PRE_TOKEN = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^\s{_LETTER}{_NUMBER}]+|\s+(?!\S)|\s+"
)


def _byte_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


class Counter:
    """Counts tokens as ``encode(text, add_special_tokens=False)`` of the library gives them."""

    def __init__(self, path: str, whole: frozenset[str] | None = None):
        self.library = Tokenizer.from_file(path)
        self.whole = self._proved() if whole is None else whole
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.rest: dict[str, int] = {}

    def _proved(self) -> frozenset[str]:
        """The vocabulary strings that encode alone as one token; the proof is that they were encoded.

        A string is of use only if it can be a pre-token: plain characters, and one match of the
        pattern. Such a string is cut in the same way alone and within a text.
        """
        of_character = _byte_characters()
        strings = []
        for shown in self.library.get_vocab(with_added_tokens=False):
            try:
                string = bytes(of_character[c] for c in shown).decode("utf-8")
            except (KeyError, UnicodeDecodeError):
                continue
            if _PLAIN.fullmatch(string) and _PRE_TOKEN.fullmatch(string):
                strings.append(string)
        found = self.library.encode_batch(strings, add_special_tokens=False)
        return frozenset(s for s, e in zip(strings, found, strict=True) if len(e.ids) == 1)

    def _merged(self, token: str) -> int:
        known = self.rest.get(token)
        if known is None:
            if len(self.rest) >= REMEMBERED:
                self.rest.clear()
            known = len(self.library.encode(token, add_special_tokens=False).ids)
            if len(token) <= 64:
                self.rest[token] = known
        return known

    def _plain(self, text: str) -> int:
        found = _PRE_TOKEN.findall(text)
        rest = [token for token in found if token not in self.whole]
        return len(found) - len(rest) + sum(map(self._merged, rest))

    def count(self, text: str) -> int:
        """The tokens of a text.

        A text with characters whose class may differ between libraries is cut at borders that no
        pre-token goes over, and only the stretches with such characters go to the library. So does a text
        with a special token's string, as a whole.
        """
        if not text:
            return 0
        if any(s in text for s in self.special):
            return len(self.library.encode(text, add_special_tokens=False).ids)
        if _PLAIN.fullmatch(text):
            return self._plain(text)
        total = 0
        for plain, pieces in groupby(_BORDER.split(text), lambda piece: _PLAIN.fullmatch(piece) is not None):
            stretch = "".join(pieces)
            total += self._plain(stretch) if plain else self._merged(stretch)
        return total


def _digest(path: str) -> str:
    return hashlib.sha256(Path(path).read_bytes()).hexdigest()


@lru_cache(maxsize=4)
def _proof(path: str, digest: str) -> frozenset[str]:
    return Counter(path).whole


#: The counter of a task's process, by the file's path and digest.
_COUNTERS: dict[tuple[str, str], Counter] = {}


def _counter(path: str, digest: str, whole: frozenset[str]) -> Counter:
    if (path, digest) not in _COUNTERS:
        if _digest(path) != digest:
            raise ValueError(f"{path} differs from the driver's file")
        _COUNTERS[path, digest] = Counter(path, whole)
    return _COUNTERS[path, digest]


def count_tokens(docs: DataFrame, path: str, text: str = "text", limit: int = LIMIT) -> DataFrame:
    """Documents with ``n_bytes``, ``n_tokens`` and ``over_limit`` in place of their text.

    ``path`` names a byte-level BPE file that all machines have, checked by its digest. Each row is
    counted by itself, whole, so nothing is shuffled. Null texts count as empty: no bytes, no tokens.
    Rows that repeat are counted alike; an empty table gives an empty one. Columns with the names of result columns are replaced.
    """
    digest = _digest(path)
    # At most one string per entry of the vocabulary.
    proof = docs.sparkSession.sparkContext.broadcast(_proof(path, digest))
    names = [n for n in without(docs, "n_bytes", "n_tokens", "over_limit").columns if n != text]
    rows = docs.select(*[quoted(n) for n in names], quoted(text).alias("counted_text"))
    schema = T.StructType([
        *[rows.schema[n] for n in names], T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(path, digest, proof.value).count
        for batch in batches:
            texts = batch.column("counted_text")
            sizes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            counts = pa.array([count(t.as_py() or "") for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], sizes, counts], names=[f.name for f in schema]
            )

    return map_arrow(rows, run, schema).withColumn("over_limit", F.col("n_tokens") > limit)
