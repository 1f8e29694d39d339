"""Near-duplicates by fast similarity sketching: rounds of hashed bin placement, banding, exact verification."""

from __future__ import annotations

from functools import lru_cache, partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm.similarity import BROADCAST_IDS, GOLDEN, similarity_classes

#: Bands of a sketch, and coordinates of a band; their product is the sketch's length.
BANDS, ROWS = 64, 6
#: Odd multipliers of the 64-bit finaliser: fixed values.
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Hashes that a pass over a set makes at most, beyond one round, for bounded memory.
PASS_HASHES = 1 << 18


def spread(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly."""
    h = (h ^ (h >> np.uint64(30))) * MIX_A
    h = (h ^ (h >> np.uint64(27))) * MIX_B
    return h ^ (h >> np.uint64(31))


@lru_cache(maxsize=4)
def seeds(length: int) -> np.ndarray:
    """What each of the 2 * length rounds adds to elements before they are hashed."""
    return spread(np.arange(1, 2 * length + 1, dtype=np.uint64) * np.uint64(GOLDEN))


def sketch(elements: np.ndarray, length: int) -> np.ndarray:
    """The coordinates of a set of distinct 64-bit numbers: uint64, all of them filled; empty for an empty set.

    In each of the first length rounds, every element falls into a bin by its hash of that round, and a bin that no earlier
    round has filled takes the least hash. Bins still empty then are filled one after the other, each by the least hash of all
    elements in a round of its own. So at most 2 * length rounds fill every bin (Dahlgaard, Knudsen and Thorup 2017); two sets
    agree in a coordinate with the probability of their Jaccard similarity, and the share of equal ones is concentrated about it as
    if all were drawn without replacement. A round's least hash in a bin is the first one there in sorted order, as bins are ranges of hashes.
    """
    n = len(elements)
    if not n:
        return np.empty(0, np.uint64)
    out, empty = np.zeros(length, np.uint64), np.ones(length, bool)
    added, start, left = seeds(length), 0, length
    while left and start < length:
        rounds = int(np.ceil(length * (np.log(left) + 2) / n))
        rounds = min(max(1, min(rounds, PASS_HASHES // n)), length - start)
        own = added[start : start + rounds]
        hashes = np.sort(spread(elements[None, :] ^ own[:, None]), axis=1)
        at = (((hashes >> np.uint64(32)) * np.uint64(length)) >> np.uint64(32)).astype(np.int64)
        first = empty[at]
        first[:, 1:] &= at[:, 1:] != at[:, :-1]
        found = np.flatnonzero(first)[::-1]
        bins = at.ravel()[found]
        out[bins] = hashes.ravel()[found] + own[found // n]  # later ones replace earlier ones: the first round stands
        empty[bins] = False
        start, left = start + rounds, int(np.count_nonzero(empty))
    rest = np.flatnonzero(empty)
    step = max(1, PASS_HASHES // n)
    for i in range(0, len(rest), step):
        own = added[length:][rest[i : i + step]]
        out[rest[i : i + step]] = spread(elements[None, :] ^ own[:, None]).min(axis=1) + own
    return out


def band_keys(elements: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A key for each band of a set's sketch: two sets share it (but for chance) if they agree in all coordinates of that band."""
    coordinates = sketch(elements, bands * rows)
    if not len(coordinates):
        return coordinates
    place = np.arange(1, bands * rows + 1, dtype=np.uint64) * np.uint64(GOLDEN)
    return spread(spread(coordinates + place).reshape(bands, rows).sum(axis=1, dtype=np.uint64))


def missed(similarity: float, bands: int = BANDS, rows: int = ROWS) -> float:
    """The probability that two sets of this similarity share no band."""
    return (1 - similarity**rows) ** bands


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
    broadcast_ids: int = BROADCAST_IDS,
) -> DataFrame:
    """(key, n_shingles, component, kept) for each row of docs: the smallest key that links lead to, and whether that is the row's own.

    Two documents link when 100 * intersection >= percent * union of their sets of word shingles, which is confirmed on the full
    sets; bands only bring candidates together. A pair at a similarity of 0.8 is in no band together with a probability of 4e-9 by the default parameters
    (missed), less so above. Equal sets are one vertex; sets of a band are compared with one of them, and what
    then could still link across components is found by rare shingles (similarity_classes), so a band of very many sets never makes all pairs
    and none is cut.

    Null and empty texts, and those without words, have no shingles, link with nothing and are kept; equal texts and rows that
    repeat a key link, and all rows with their component's smallest key are kept. A row with a null key has null n_shingles and component,
    links with nothing and is kept. Keys are of any type with an order. An empty docs gives no rows; a very long text is one task's work, in passes of bounded size.
    """
    keys = partial(band_keys, bands=bands, rows=rows)
    found = similarity_classes(docs, key, text, shingle, percent, broadcast_ids, keys)
    return found.withColumn("kept", F.coalesce(F.col(key) == F.col("component"), F.lit(True)))


def plain_sketch(elements: list[int], length: int) -> list[int]:
    """sketch, an element and a round at a time; for tests."""
    out: list[int | None] = [None] * length
    for i in range(2 * length):
        if None not in out:
            break
        own = int(seeds(length)[i])
        held: dict[int, int] = {}
        for x in elements:
            h = int(spread(np.array([x ^ own], np.uint64))[0])
            b = (h >> 32) * length >> 32 if i < length else i - length
            held[b] = min(h, held.get(b, h))
        for b, h in held.items():
            if out[b] is None:
                out[b] = (h + own) % 2**64
    return out
