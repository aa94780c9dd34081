"""Which trigrams a text must hold for a regular expression to match in it, and an inverted index of trigrams."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from re import _constants as op
from re import _parser as parser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A query is a set of alternatives; each is a set of trigrams, all of which a matching text holds in lower case.
Query = frozenset[frozenset[str]]
ALWAYS: Query = frozenset([frozenset()])
MOST_STRINGS = 64
MOST_ALTERNATIVES = 32
MOST_CHARACTERS = 12  # of a class that is followed letter by letter
BLOCK_ROWS = 4096  # bounds a posting list


def either(queries: Iterable[Query]) -> Query:
    """Any of the queries. An alternative that asks for more than another one adds nothing."""
    every = frozenset().union(*queries)
    least = frozenset(a for a in every if not any(b < a for b in every))
    return least if len(least) <= MOST_ALTERNATIVES else ALWAYS


def both(a: Query, b: Query) -> Query:
    product = either([frozenset(x | y for x in a for y in b)]) if len(a) * len(b) <= MOST_ALTERNATIVES**2 else ALWAYS
    # Too many alternatives: one side alone asks for less, and still for what every match holds.
    return product if product != ALWAYS else max(a, b, key=lambda q: min(map(len, q)))


def of_strings(strings: Iterable[str]) -> Query:
    return either([frozenset([frozenset(s[i : i + 3] for i in range(len(s) - 2))]) for s in strings])


class Run:
    """What has been read of a concatenation: the strings it may end in, and the query of all before."""

    def __init__(self) -> None:
        self.ends, self.query = frozenset([""]), ALWAYS

    def close(self, keep: int) -> None:
        """Ask for what the strings hold. Their last ``keep`` characters go on into what follows."""
        self.query = both(self.query, of_strings(self.ends))
        self.ends = frozenset(s[max(len(s) - keep, 0) :] for s in self.ends) if keep else frozenset([""])

    def add(self, strings: frozenset[str] | None, query: Query) -> None:
        if strings is None:
            self.close(0)
            self.query = both(self.query, query)
            return
        if len(self.ends) * len(strings) > MOST_STRINGS:
            self.close(2)
        if len(self.ends) * len(strings) > MOST_STRINGS:
            self.close(0)
        self.ends = frozenset(a + b for a in self.ends for b in strings)


def _set(items: list) -> frozenset[str] | None:
    """The characters of a class, in lower case, if they are few."""
    found: set[str] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            found.add(chr(value).lower())
        elif kind is op.RANGE and value[1] - value[0] < 4 * MOST_CHARACTERS:
            found.update(chr(c).lower() for c in range(value[0], value[1] + 1))
        else:
            return None
    return frozenset(found) if len(found) <= MOST_CHARACTERS else None


def _walk(parts) -> tuple[frozenset[str] | None, Query]:
    """All strings that the parts match, if those are few, else a query for what they hold."""
    run, whole = Run(), True
    for kind, value in parts:
        strings, query = None, ALWAYS
        if kind is op.LITERAL:
            strings = frozenset([chr(value).lower()])
        elif kind is op.IN:
            strings = _set(value)
        elif kind is op.SUBPATTERN:
            strings, query = _walk(value[-1])
        elif kind is op.BRANCH:
            found = [_walk(branch) for branch in value[1]]
            if all(s is not None for s, _ in found):
                strings = frozenset().union(*[s for s, _ in found])
            else:
                query = either([of_strings(s) if s is not None else q for s, q in found])
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
            least, most, inner = value
            strings, query = _walk(inner)
            if (least, most) == (0, 1) and strings is not None:
                strings = strings | {""}
            elif least == 0:
                strings, query = None, ALWAYS
            elif strings is not None and (least, most) != (1, 1):
                # the string so often at least, then perhaps more
                for _ in range(min(least, 8)):
                    run.add(strings, ALWAYS)
                if least > 8 or most != least:
                    run.close(0)
                    whole = False
                continue
        elif kind in (op.AT, op.ASSERT, op.ASSERT_NOT):
            continue
        if strings is None:
            whole = False
        run.add(strings, query)
        whole = whole and run.query == ALWAYS and len(run.ends) <= MOST_STRINGS and strings is not None
    if whole and run.query == ALWAYS:
        return run.ends, ALWAYS
    run.close(0)
    return None, run.query


def trigram_query(pattern: str) -> Query:
    """Alternatives of trigrams, in lower case, that a text holds wherever the pattern matches; ``ALWAYS`` if none is certain.

    Patterns use what Java's and Python's regular expressions have in common.
    """
    strings, query = _walk(parser.parse(pattern, re.ASCII))
    return query if strings is None else of_strings(strings)


def postings(texts: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    """The inverted index of (row, text) for some trigrams: (trigram, block, rows).

    A list holds the rows of a block of neighbouring ones, so its length is bounded however frequent the trigram is.
    """
    table = F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in vocabulary])
    held = texts.select("row", F.lower("text").alias("low")).select("row", F.explode(F.array_compact(table)).alias("trigram"))
    block = F.floor(F.col("row") / BLOCK_ROWS).cast("long")
    return held.groupBy("trigram", block.alias("block")).agg(F.sort_array(F.collect_list("row")).alias("rows"))


def candidates(index: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """(row, rule): texts that hold all trigrams of some alternative of the rule's query. Lists are met a block at a time."""
    asked = [
        (rule, n, len(alternative), trigram)
        for rule, query in sorted(queries.items())
        for n, alternative in enumerate(sorted(query, key=sorted))
        for trigram in sorted(alternative)
    ]
    # as many rows as the rules have trigrams
    wanted = F.broadcast(index.sparkSession.createDataFrame(asked, "rule string, alternative int, size int, trigram string"))
    lists = index.join(wanted, "trigram").groupBy("block", "rule", "alternative", "size").agg(F.collect_list("rows").alias("lists"))
    met = F.reduce(F.slice("lists", 2, F.greatest(F.size("lists") - 1, F.lit(0))), F.get("lists", F.lit(0)), F.array_intersect)
    return lists.filter(F.size("lists") == F.col("size")).select(F.explode(met).alias("row"), "rule").distinct()
