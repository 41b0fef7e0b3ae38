"""Puts each query together with the common table expressions it needs."""

from __future__ import annotations

import re

from lumenmart.oracle.base import CTES
from lumenmart.oracle.queries import LOCAL_CTES, QUERIES


def with_ctes(sql: str, ctes: dict[str, str]) -> str:
    order: list[str] = []

    def need(text: str) -> None:
        for name in ctes:
            if name not in order and re.search(rf"\b{name}\b", text):
                need(ctes[name])
                order.append(name)

    need(sql)
    return ("WITH " + ",\n".join(f"{n} AS ({ctes[n]})" for n in order) + "\n" if order else "") + sql


def oracle_queries() -> dict[str, str]:
    out = {}
    for name, sql in QUERIES.items():
        own = LOCAL_CTES.get(name, {})
        # A local expression that replaces a common one finds that as <name>0.
        replaced = {f"{n}0": CTES[n] for n in own if n in CTES}
        out[name] = with_ctes(sql, {**CTES, **replaced, **own})
    return out
