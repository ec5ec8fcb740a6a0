"""Partners that titles share users with, counted from the lists of one group of titles, for use inside a task."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

#: A title, a partner and the users they share.
PARTNERS = "a bigint, b bigint, shared bigint"
#: Such partners, or a class, a class that it shares large users with, and their number.
CLASS_PARTNERS = f"{PARTNERS}, bin int, of_class boolean"
_TITLE_BITS = 40


def _starts(keys: np.ndarray) -> np.ndarray:
    """Where a new value starts in a sorted array."""
    return np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table[name].to_numpy().astype(np.int64)


def _flat(table: pa.Table, name: str) -> np.ndarray:
    values = np.concatenate([np.zeros(0), *[chunk.flatten().fill_null(-1).to_numpy() for chunk in table[name].chunks]])
    return values.astype(np.int64)


def _counts(lists: pa.Table, names: np.ndarray, beside: str | None, itself: bool = False) -> tuple[np.ndarray, ...]:
    """Place of the title in ``names``, partner and number of lists, sorted by title and partner, and what is beside it.
    ``itself`` keeps the title among its partners."""
    sizes = np.concatenate([np.zeros(0, np.int64), *[chunk.value_lengths().to_numpy() for chunk in lists["list"].chunks]])
    titles = np.repeat(np.searchsorted(names, _column(lists, "a")), sizes)
    partners = _flat(lists, "list")
    other = slice(None) if itself else np.flatnonzero(names[titles] != partners)
    keys = titles[other] << _TITLE_BITS | partners[other]
    if beside is None:
        keys.sort()
        extra = None
    else:
        order = np.argsort(keys)
        keys, extra = keys[order], _flat(lists, beside)[other][order]
    starts = _starts(keys)
    shared = np.diff(np.r_[starts, len(keys)])
    keys = keys[starts]
    return keys >> _TITLE_BITS, keys & (1 << _TITLE_BITS) - 1, shared, None if extra is None else extra[starts]


def _first(names: np.ndarray, title: np.ndarray, partner: np.ndarray, shared: np.ndarray, limit: int) -> pa.Table:
    """The ``limit`` smallest partners of each title among those of equal count; most counts are 1 and in order already."""
    chosen = []
    for some in (np.flatnonzero(shared == 1), np.flatnonzero(shared > 1)):
        if len(some) and shared[some[0]] > 1:
            some = some[np.lexsort((shared[some], title[some]))]
        starts = _starts(title[some] << 32 | shared[some])
        nth = np.arange(len(some)) - np.repeat(starts, np.diff(np.r_[starts, len(some)]))
        chosen.append(some[nth < limit])
    at = np.concatenate(chosen)
    return pa.table({"a": names[title[at]], "b": partner[at], "shared": shared[at]})


def first_partners(limit: int) -> Callable[[pa.Table], pa.Table]:
    """From (a, list)."""
    def find(lists: pa.Table) -> pa.Table:
        names = np.unique(_column(lists, "a"))
        title, partner, shared, _ = _counts(lists, names, None)
        return _first(names, title, partner, shared, limit)

    return find


def first_with_classes(limit: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """From (a, own, bin, list, class), where ``class`` holds the class of each partner or NULL and ``own`` that of the title,
    and (a, bin, list) with the classes of large users: a pair's count is increased by the overlap of its classes, which is
    how many lists of large users hold both. Of each class come the ``limit + 1`` first classes of each overlap."""
    def find(lists: pa.Table, met: pa.Table) -> pa.Table:
        classes = np.unique(_column(met, "a"))
        of, partner, overlap, _ = _counts(met, classes, None, itself=True)
        names, first = np.unique(_column(lists, "a"), return_index=True)
        own = lists["own"].fill_null(-1).to_numpy().astype(np.int64)[first]
        title, other, shared, others_class = _counts(lists, names, "class")
        if len(of) and len(title):
            keys = of << _TITLE_BITS | partner
            place = np.minimum(np.searchsorted(classes, own), len(classes) - 1)
            known = (classes[place] == own)[title] & (others_class >= 0)
            wanted = np.where(known, place[title] << _TITLE_BITS | np.maximum(others_class, 0), -1)
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            shared = shared + np.where(keys[at] == wanted, overlap[at], 0)
        titles, of_class = _first(names, title, other, shared, limit), _first(classes, of, partner, overlap, limit + 1)
        n, m = titles.num_rows, of_class.num_rows
        return pa.concat_tables([titles, of_class]).append_column(
            "bin", pa.array(np.full(n + m, (lists if lists.num_rows else met)["bin"][0].as_py(), np.int32))
        ).append_column("of_class", pa.array(np.arange(n + m) >= n))

    return find
