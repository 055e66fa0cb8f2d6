"""Names inside texts, all of them in one pass over each text.

Up to ``HELD`` names go to the workers, which build one automaton of all names for each scope (a city, say)
and run every text through it once: time grows with the text and its hits, not with the lengths that names
have, and nothing is shuffled.  More names than that stay in the cluster: the text's substrings of the
lengths that names have meet them in the join that follows.
"""

from __future__ import annotations

import uuid

import ahocorasick
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Names of which every worker holds a copy; some 200 bytes each in an automaton.
HELD = 200_000
#: Automata of so many name tables are kept by a worker.
_KEPT = 8
_BUILT: dict[str, dict[tuple, ahocorasick.Automaton]] = {}


def name_lengths(keys: DataFrame, *names: str) -> list[int]:
    """The lengths that names have: at most as many as the longest has characters."""
    lengths = keys.select(F.explode(F.array(*(F.length(n) for n in names))).alias("n")).where("n > 0").distinct()
    return sorted(r["n"] for r in lengths.collect())


def substrings(text: Column, lengths: list[int]) -> Column:
    """All distinct substrings of the given lengths."""
    none = F.array().cast("array<string>")
    if not lengths:
        return none

    def of(n: Column) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.length(text) - n + 1, F.lit(1)))
        return F.when(F.length(text) >= n, F.transform(places, lambda i: F.substr(text, i, n))).otherwise(none)

    return F.array_distinct(F.flatten(F.transform(F.array(*map(F.lit, lengths)), of)))


def _automata(token: str, shared: Broadcast) -> dict[tuple, ahocorasick.Automaton]:
    """One automaton a scope, built once a worker."""
    if token not in _BUILT:
        built: dict[tuple, ahocorasick.Automaton] = {}
        for *scope, name in shared.value:
            built.setdefault(tuple(scope), ahocorasick.Automaton()).add_word(name, name)
        for automaton in built.values():
            automaton.make_automaton()
        while len(_BUILT) >= _KEPT:
            _BUILT.pop(next(iter(_BUILT)))
        _BUILT[token] = built
    return _BUILT[token]


def names_in(df: DataFrame, text: str, names: DataFrame, name: str, scope: tuple[str, ...] = (), least: int = 1) -> Column:
    """An array of what in the text may be a name of its scope: all names of ``least`` characters or more that are there.

    Null and empty texts and names, and null scopes, give none.  Join the elements with the names: where these
    are many the array holds other substrings too.
    """
    known = names.where(F.length(name) >= least).select(*scope, name).distinct()
    held = [tuple(r) for r in known.limit(HELD + 1).collect()]
    if len(held) > HELD:
        return substrings(F.col(text), [n for n in name_lengths(names, name) if n >= least])
    shared, token = df.sparkSession.sparkContext.broadcast([r for r in held if None not in r]), uuid.uuid4().hex

    def find(texts: pd.Series, *scopes: pd.Series) -> pd.Series:
        automata = _automata(token, shared)
        out = []
        for t, *s in zip(texts, *scopes, strict=True):
            automaton = automata.get(tuple(s)) if t else None
            out.append(list(dict.fromkeys(hit for _, hit in automaton.iter(t))) if automaton else [])
        return pd.Series(out, dtype=object)

    return F.pandas_udf(find, "array<string>")(F.col(text), *map(F.col, scope))
