"""Small vocabularies as literal columns.

Each is one parsed expression; building it from single literals would cost a
call to the JVM per word.
"""

from __future__ import annotations

import zlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def array_text(words: Sequence[str]) -> str:
    return f"CAST(array({', '.join(quoted(w) for w in words)}) AS array<string>)"


def text_array(words: Sequence[str]) -> Column:
    return F.expr(array_text(words))


def text_map(table: Mapping[str, str]) -> Column:
    return F.expr(f"map({', '.join(quoted(x) for pair in table.items() for x in pair)})")


_ITEM, _PAIR, _KEY = "\u0002", "\u0003", "\u0004"


def folded_array(words: Sequence[str]) -> Column:
    """A long array from one literal, which the optimizer cuts up once."""
    return F.split(F.lit(_ITEM.join(words)), _ITEM)


def folded_map(table: Mapping[str, str]) -> Column:
    """A long map from one literal, which the optimizer cuts up once."""
    return F.str_to_map(F.lit(_packed(table)), F.lit(_PAIR), F.lit(_KEY))


def _packed(table: Mapping[str, str]) -> str:
    return _PAIR.join(k + _KEY + v for k, v in table.items())


class HashedMap:
    """A map of thousands of words, dealt into buckets by checksum.

    A lookup reads the few words of one bucket, however many there are.
    """

    def __init__(self, table: Mapping[str, str], buckets: int) -> None:
        dealt: list[dict[str, str]] = [{} for _ in range(buckets)]
        for word, text in table.items():
            dealt[zlib.crc32(word.encode()) % buckets][word] = text
        self.buckets, self.packed = buckets, [_packed(d) for d in dealt]

    def get(self, word: Column) -> Column:
        """Text of a word; null for an unknown one."""
        place = F.pmod(F.crc32(word), F.lit(self.buckets)).cast("int")
        return F.try_element_at(F.str_to_map(folded_array(self.packed)[place], F.lit(_PAIR), F.lit(_KEY)), word)


def without_redundant(words: Sequence[str]) -> list[str]:
    """Words that can decide a substring test: none that contains another one."""
    return [w for w in dict.fromkeys(words) if not any(o != w and o in w for o in words)]
