"""Repeatable uniforms: the same key, seed and purpose always give the same draw."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a uniform is for.  Each purpose has draws of its own, so rows picked by one are not
# special under another.
DRAW, SAMPLE, SYNTH = "draw", "sample", "synth"


def hash_uniform(
    keys: Sequence[str], seed: int, purpose: str = DRAW, *, method: str = "md5"
) -> Column:
    """A uniform in [0, 1) from a hash of purpose, seed and key parts.

    Unlike ``rand(seed)`` this depends neither on partitioning nor on row order, so a
    retried task draws what the lost one drew.  Each part is written with its length, or
    as ``-`` if NULL, so different keys never read alike; a key whose parts are all NULL
    fails the job.

    ``md5`` (the first 32 bits) can be computed by any SQL engine; ``xxhash64`` is several
    times faster and has 53 bits.
    """
    if method not in ("md5", "xxhash64"):
        raise ValueError(f"method must be 'md5' or 'xxhash64', not {method!r}")
    texts = [F.col(k).cast("string") for k in keys]
    parts = [
        F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts
    ]
    text = F.concat_ws("|", F.lit(purpose), F.lit(str(seed)), *parts)
    if method == "md5":
        head = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10)
        uniform = head.cast("double") / F.lit(4294967296.0)
    else:
        bits = F.shiftrightunsigned(F.xxhash64(text), 11)
        uniform = bits.cast("double") / F.lit(float(1 << 53))
    nothing = reduce(lambda a, b: a & b, [t.isNull() for t in texts])
    missing = F.raise_error(F.lit(f"all parts of the key are NULL: {', '.join(keys)}"))
    return F.when(nothing, missing.cast("double")).otherwise(uniform)
