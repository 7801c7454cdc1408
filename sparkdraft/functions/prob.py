"""Sampling probabilities and pointwise mutual information as expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def miss_table(deck_size: int, cards_seen: int) -> list[float]:
    """P(no copy is seen) for k = 0 .. deck_size - cards_seen copies.

    Both parameters are constants of the query, so the hypergeometric quotient
    ``C(D-k, s) / C(D, s)`` is a short table fixed when the plan is built. Row
    work is one array lookup in generated code instead of four log-gamma calls.
    """
    total = math.comb(deck_size, cards_seen)
    return [math.comb(deck_size - k, cards_seen) / total
            for k in range(deck_size - cards_seen + 1)]


def p_missed(copies: Column, deck_size: int, cards_seen: int) -> Column:
    """0 when fewer than ``cards_seen`` other cards remain."""
    table = F.array(*[F.lit(v) for v in miss_table(deck_size, cards_seen)])
    return F.coalesce(F.get(table, copies.cast("int")), F.lit(0.0))


def p_seen(copies: Column, deck_size: int, cards_seen: int) -> Column:
    return F.lit(1.0) - p_missed(copies, deck_size, cards_seen)


def p_seen_together(a: Column, b: Column, deck_size: int, cards_seen: int) -> Column:
    """Both cards are seen, by inclusion and exclusion."""
    return (
        F.lit(1.0)
        - p_missed(a, deck_size, cards_seen)
        - p_missed(b, deck_size, cards_seen)
        + p_missed(a + b, deck_size, cards_seen)
    )


def pmi(p_ab: Column, p_a: Column, p_b: Column) -> Column:
    return F.ln(F.try_divide(p_ab, p_a * p_b))


def ppmi(value: Column) -> Column:
    return F.greatest(value, F.lit(0.0))


def check_sampling(deck_size: int, cards_seen: int, min_pair_prob: float = 0.0,
                   components: int = 1) -> None:
    """Refuse job parameters out of range, naming all of them at once."""
    ranges = {"deck_size": (deck_size, 1, None), "cards_seen": (cards_seen, 1, deck_size),
              "min_pair_prob": (min_pair_prob, 0, None), "components": (components, 1, None)}
    wrong = [f"{name} = {value}, allowed from {low} to {'any' if high is None else high}"
             for name, (value, low, high) in ranges.items()
             if value < low or (high is not None and value > high)]
    if wrong:
        raise ValueError("; ".join(wrong))
