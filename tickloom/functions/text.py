"""Symbol names and search-reply text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SEARCH_HIT = "array<struct<symbol:string,description:string,exchange:string,type:string>>"


def format_symbol(symbol: Column, exchange: Column, contract: Column | int | str | None = None) -> Column:
    """``EXCH:SYM``, ``EXCH:SYM{n}!`` for a futures contract, full names unchanged.

    A plain Python ``contract`` must be an integer; a column must be integral
    and marks rows without a contract by NULL.
    """
    plain = F.concat(exchange, F.lit(":"), symbol)
    if contract is None:
        named = plain
    elif isinstance(contract, Column):
        named = F.when(contract.isNull(), plain).otherwise(F.concat(plain, contract.cast("string"), F.lit("!")))
    elif isinstance(contract, int) and not isinstance(contract, bool):
        named = F.concat(plain, F.lit(f"{contract}!"))
    else:
        raise ValueError("not a valid contract")
    return F.when(F.contains(symbol, F.lit(":")), symbol).otherwise(named)


def strip_markup(text: Column) -> Column:
    """Drop the emphasis tags a symbol search puts around matches."""
    return F.regexp_replace(text, "</?em>", "")


def search_hits(text: Column) -> Column:
    """Search reply text to an array of hits; unreadable text gives NULL."""
    return F.from_json(strip_markup(text), SEARCH_HIT)
