"""Allow and block rules for urls, looked up in Bloom filter cascades.

A cascade holds a set exactly, as far as one known universe of keys goes: its first level is
a Bloom filter of the listed keys, its second one of the keys of the universe that pass the
first by mistake, its third one of the listed keys that pass the second by mistake, and so on
until a level has no mistakes. The universe here is every key that any url of the corpus looks
up, so each lookup is exact, and needs no join: the levels are a few bits for each listed key
and travel inside the plan, up to a stated number of them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.llm.shared import stored

#: Bits of a level that travel in the plan: 4 MB, some ten million characters of text. That is enough for about three
#: million rules; a larger list ends with an error.
MOST_BITS = 1 << 25

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    """From the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, URL_PARTS, 1), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host, up to `?`, `#` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, URL_PARTS, 2), F.lit(""))


def lookup_keys(host: Column, path: Column, lengths: Sequence[int]) -> Column:
    """The rules that could fit, the longest first: each parent domain with each path prefix of a
    length that any rule has. Of two keys of one length the one with the longer host comes first."""
    labels = F.split(host, r"\.", -1)
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(path))
    keys = F.flatten(
        F.transform(
            domains,
            lambda d: F.transform(
                fitting,
                lambda n: F.struct(
                    (F.length(d) + n).alias("long"), F.length(d).alias("host_long"),
                    F.concat(d, F.substring(path, F.lit(1), n)).alias("key"),
                ),
            ),
        )
    )
    return F.transform(F.sort_array(keys, asc=False), lambda k: k["key"])


@dataclass(frozen=True)
class Level:
    """One Bloom filter; `words` are its bits, 64 in each."""

    words: tuple[int, ...]
    bits: int
    seeds: tuple[int, ...]

    def positions(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(s)), F.lit(self.bits)) for s in self.seeds]

    def has(self, key: Column) -> Column:
        # One text constant that the optimizer folds into one array; not a plan node for each word.
        words = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")
        found = F.lit(True)
        for at in self.positions(key):
            word = F.get(words, F.shiftright(at, 6).cast("int"))
            found &= F.call_function("getbit", word, at.bitwiseAND(63).cast("int")) == 1
        return found


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...] = field(default=())

    def has(self, key: Column) -> Column:
        """Whether `key`, if it is in the universe, is listed."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            answer = F.when(self.levels[i].has(key), answer).otherwise(F.lit(i % 2 == 1))
        return answer


def _level(keys: DataFrame, count: int, mistakes: float, seed: int) -> Level:
    bits = max(64, math.ceil(count * math.log2(1 / mistakes) / math.log(2)))
    if bits > MOST_BITS:
        raise ValueError(f"{count} keys need {bits} bits; more than {MOST_BITS} do not go into a plan")
    hashes = max(1, round(bits / count * math.log(2)))
    level = Level((), bits, tuple(range(seed, seed + min(hashes, 30))))
    at = keys.select(F.explode(F.array(*level.positions(F.col("key")))).alias("at"))
    words = dict(
        at.groupBy(F.shiftright("at", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits"))
        .collect()
    )
    return Level(tuple(words.get(i, 0) for i in range(math.ceil(bits / 64))), bits, level.seeds)


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """The cascade of the keys in `listed`, exact for all keys in `universe` (both: column `key`).

    The first level is sized so that about as many other keys pass by mistake as are listed; the
    later ones let half of them pass, so all levels together take a few bits for each listed key
    and for each doubling of the universe. Only those bits come to the driver.
    """
    wanted = listed.select("key").where("key is not null").distinct()
    other = universe.select("key").where("key is not null").distinct().join(wanted, "key", "left_anti")
    n, m = wanted.count(), other.count()
    levels: list[Level] = []
    while n:
        mistakes = min(0.5, n / (2 * m)) if m and not levels else 0.5
        levels.append(_level(wanted, n, mistakes, 64 * len(levels)))
        wanted, other = other.where(levels[-1].has(F.col("key"))), wanted
        n = wanted.count()
    return Cascade(tuple(levels))


def judge_urls(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """`page_id, host, path, rule, verdict` for every row of `pages` (`page_id, url`).

    `rules` has `host, path, verdict` (allow or block). A rule fits its host and all subdomains if
    the path starts with the rule's; the longest fitting rule decides, and a url that no rule fits
    is not in the block list and thus allowed. A rule in both lists blocks. A null url, or one
    without `://`, has an empty host and path; such a row keeps its place in the result, as do
    repeated rows. Other columns of `pages` are not read. Rules with a null host or path are void.
    """
    rules = rules.where("host is not null and path is not null").select(
        F.concat("host", "path").alias("key"), F.length("path").alias("long"), "verdict"
    )
    lengths = sorted(r.long for r in rules.select("long").distinct().collect())
    parts = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    keys = lookup_keys(F.col("host"), F.col("path"), lengths) if lengths else F.array().cast("array<string>")
    universe = stored(parts.select("host", "path").distinct().select(F.explode(keys).alias("key")).distinct(), "url_keys")
    block = build_cascade(rules.where("verdict = 'block'"), universe)
    allow = build_cascade(rules.where("verdict = 'allow'"), universe)
    rule = F.get(F.filter(keys, lambda k: block.has(k) | allow.has(k)), F.lit(0))
    verdict = F.when(F.col("rule").isNotNull() & block.has(F.col("rule")), "block").otherwise("allow")
    return parts.withColumn("rule", rule).withColumn("verdict", verdict)
