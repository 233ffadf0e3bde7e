"""Minimal perfect hashes in shards: every key has a slot of its own, and slots have no gaps.

A shard is built level by level. On a level every key left hashes to one of twice as many places; keys alone in their
place stay there, the others go to the next level. The slot of a key is the number of taken places before its own over
all levels. A key that was never put in also gets some slot, so the stored key of the slot is compared with it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Places per key left on a level.
ROOM = 2
#: Levels after which keys that still share places must have equal 128-bit hashes.
LEVELS = 200


def digests(keys: list[bytes]) -> np.ndarray:
    """Two 64-bit numbers for each key."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), dtype="<u8").reshape(-1, 2)


def shard_hash(keys: list[bytes]) -> np.ndarray:
    """The 64-bit hash that deals keys to shards, equal to Spark's ``xxhash64`` of the same bytes."""
    return np.fromiter((xxhash.xxh64_intdigest(k, 42) for k in keys), dtype=np.uint64, count=len(keys))


def _place(h: np.ndarray, level: int, size) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = h[:, 0] + np.uint64(level) * (h[:, 1] | np.uint64(1))
        x ^= x >> np.uint64(31)
        x *= np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
    return (x % np.asarray(size, dtype=np.uint64)).astype(np.int64)


def build(keys: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The levels (one bit per place, packed, behind the number of places) and the slot of each of the distinct keys."""
    h = digests(keys)
    slots, left, used, levels = np.zeros(len(keys), dtype=np.int64), np.arange(len(keys)), 0, []
    while len(left):
        if len(levels) == LEVELS:
            raise ValueError("keys with equal hashes, or given twice")
        size = max(8, ROOM * len(left))
        at = _place(h[left], len(levels), size)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(size.to_bytes(8, "little") + np.packbits(alone).tobytes())
        ranks = np.cumsum(alone) - 1
        done = alone[at]
        slots[left[done]] = used + ranks[at[done]]
        used += int(alone.sum())
        left = left[~done]
    return levels, slots


@dataclass
class Shards:
    """Many shards in flat arrays, looked up together; ``keys`` holds the stored key of each slot, shard after shard."""

    first: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    keys: pa.Array

    @classmethod
    def load(cls, levels: list[list[bytes]], keys: pa.Array, sizes: np.ndarray) -> Shards:
        """From the levels of each shard, all stored keys, and the number of keys of each shard."""
        flat = []
        used = np.zeros(len(levels), dtype=np.int64)
        for depth in range(max(map(len, levels), default=0)):
            places, offsets, table, total = np.ones(len(levels), np.int64), np.zeros(len(levels), np.int64), [], 0
            for shard, own in enumerate(levels):
                offsets[shard] = total
                if depth < len(own):
                    size = int.from_bytes(own[depth][:8], "little")
                    taken = np.unpackbits(np.frombuffer(own[depth], np.uint8, offset=8), count=size).astype(bool)
                    ranks = np.where(taken, used[shard] + np.cumsum(taken) - 1, -1).astype(np.int32)
                    places[shard] = size
                    used[shard] += int(taken.sum())
                else:
                    ranks = np.full(1, -1, dtype=np.int32)
                table.append(ranks)
                total += len(ranks)
            flat.append((offsets, places, np.concatenate(table)))
        return cls(np.cumsum(sizes) - sizes, flat, keys)

    def find(self, keys: list[bytes], shard: np.ndarray) -> np.ndarray:
        """Slot over all shards of each key in its shard; -1 where the stored key is another one."""
        found = np.full(len(keys), -1, dtype=np.int64)
        if not len(keys) or not len(self.keys):
            return found
        h, left = digests(keys), np.arange(len(keys))
        for level, (offsets, places, table) in enumerate(self.levels):
            own = shard[left]
            slot = table[offsets[own] + _place(h[left], level, places[own])]
            hit = slot >= 0
            found[left[hit]] = self.first[own[hit]] + slot[hit]
            left = left[~hit]
            if not len(left):
                break
        at = np.flatnonzero(found >= 0)
        given = pa.array(keys, type=pa.binary()).take(pa.array(at))
        same = pc.equal(self.keys.take(pa.array(found[at])), given).to_numpy(zero_copy_only=False)
        found[at[~same]] = -1
        return found
