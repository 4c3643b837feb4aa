"""Token counts by overlap resynchronisation.

Ordinary texts are encoded whole. A huge text is encoded in chunks that overlap;
two neighbours are spliced at a boundary inside the overlap that is stable in
both: a white-space character, which no token crosses and beyond which the
tokenizer never looks, with the token behind it equal in place and id in both
encodings. Where an overlap holds no such place it is widened, at most until the
chunk starts where the last splice was, and then the chunk grows.

Null and empty texts count 0. Rows may repeat; each is counted. An empty table
gives an empty table. Columns beyond doc_id and text are ignored, whatever their
names.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm import wordbpe
from broadsheet.llm.frames import map_batches

CHUNK = 16_384
OVERLAP = 512
HUGE = 65_536
LIMIT = 2048

Token = tuple[int, int, int]  # start, end, id
SPACE = re.compile("[\t\n\x0b\x0c\r ]")


def splice(
    text: str, encode: Callable[[str], list[Token]], chunk: int = CHUNK, overlap: int = OVERLAP
) -> list[int]:
    """The ids of ``text`` from overlapping chunks; equal to those of one encoding."""
    out: list[int] = []
    n, start = len(text), 0
    size = chunk
    end = min(n, start + size)
    held = encode(text[start:end])
    while end < n:
        width = overlap
        while True:
            begin = max(start, end - width)
            stop = min(n, begin + max(size, 2 * width))
            other = [(a + begin, b + begin, i) for a, b, i in encode(text[begin:stop])]
            cut = _stable(text, held, other, begin, end) if stop > end else None
            if cut is not None or begin == start:
                break
            width *= 2
        if cut is None:
            # No stable place back to the last splice: a larger chunk from there.
            size *= 2
            end = min(n, start + size)
            held = [(a + start, b + start, i) for a, b, i in encode(text[start:end])]
            continue
        out += [i for a, _, i in held if a < cut]
        start, end, size = cut, stop, chunk
        held = [t for t in other if t[0] >= cut]
    return out + [i for _, _, i in held]


def _stable(text: str, held: list[Token], other: list[Token], begin: int, end: int) -> int | None:
    """The last white space in [begin, end) behind which both encodings agree."""
    there = set(other)
    follow = [t for t in held if t[0] >= begin]
    for space in reversed([m.start() for m in SPACE.finditer(text, begin + 1, end)]):
        behind = next((t for t in follow if t[0] > space), None)
        # The token must end before the chunk does, else the cut may have made it.
        if behind and behind[1] < end and behind in there and not any(a < space < b for a, b, _ in follow):
            return space
    return None


def count_tokens(
    docs: DataFrame, tokenizer: str | None = None, limit: int = LIMIT,
    huge: int = HUGE, chunk: int = CHUNK, overlap: int = OVERLAP,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs``."""
    path = tokenizer or wordbpe.default_path()

    def count(text: str | None) -> int:
        encoder = wordbpe.encoder(path)
        if text is None or len(text) <= huge:
            return len(encoder.encode(text)) // 4

        def encode(part: str) -> list[Token]:
            e = encoder.tokenizer.encode(part, add_special_tokens=False)
            return [(a, b, i) for (a, b), i in zip(e.offsets, e.ids)]

        return len(splice(text, encode, chunk, overlap))

    def run(batch):
        n = [count(t) for t in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "n_bytes": batch.column("n_bytes"), "n_tokens": n,
                "over_limit": [x > limit for x in n]}

    rows = docs.select("doc_id", "text", F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_bytes"))
    return map_batches(rows, run, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
