"""Judging within a budget: a durable ledger on the driver, a transport given by the caller."""

from __future__ import annotations

import concurrent.futures
import hashlib
import json
import sqlite3
from collections.abc import Callable, Iterable
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import jsons

#: What a judgment may say, and the words that people use for its decisions.
DECISIONS = ("keep", "review", "repair", "drop")
DIMENSIONS = ("correctness", "language_quality", "instruction_following")
RATINGS = ("pass", "fail", "uncertain")
HUMAN = {"keep": "usable", "repair": "flawed", "drop": "flawed", "review": "unsure"}
REASONS, REASON_CHARS = 3, 2000
SCHEMA = f"decision string, reasons array<string>, dimensions struct<{', '.join(f'{d}:string' for d in DIMENSIONS)}>"
#: Control characters but for the line feed and the tab.
CONTROL = r"[\x00-\x08\x0B-\x1F\x7F]"


def agrees(decision: Column, marks: Column) -> Column:
    """Whether a decision goes with the marks (an array): what is kept passes in all, what is repaired or dropped fails in one."""
    failed = F.array_contains(marks, "fail")
    return F.when(decision == "keep", ~failed & ~F.array_contains(marks, "uncertain")).when(decision.isin("repair", "drop"), failed).otherwise(F.lit(True))


def judgment_fault(text: Column) -> Column:
    """What is wrong with a judgment given as JSON: json, keys, decision, reasons, dimensions or contradiction; null if nothing is.  Columns only."""
    v = F.try_parse_json(text)
    kind = lambda path: F.schema_of_variant(F.try_variant_get(v, path, "variant"))
    keys = lambda path: F.array_sort(F.map_keys(F.try_variant_get(v, path, "map<string,variant>")))
    names = lambda *given: F.array(*map(F.lit, sorted(given)))
    same = lambda a, b: F.coalesce(a == b, F.lit(False))
    decision = F.when(kind("$.decision") == "STRING", F.try_variant_get(v, "$.decision", "string"))
    reasons = F.try_variant_get(v, "$.reasons", "array<variant>")
    said = F.transform(reasons, lambda r: F.when(F.schema_of_variant(r) == "STRING", r.cast("string")))
    sound = F.forall(said, lambda r: r.isNotNull() & r.rlike(r"\S") & (F.length(r) <= REASON_CHARS) & ~r.rlike(CONTROL))
    marks = F.array(*(F.when(kind(f"$.dimensions.{d}") == "STRING", F.try_variant_get(v, f"$.dimensions.{d}", "string")) for d in DIMENSIONS))
    rated = F.forall(marks, lambda m: F.coalesce(m.isin(*RATINGS), F.lit(False)))
    return (
        F.when(v.isNull(), "json")
        .when(~same(keys("$"), names("decision", "reasons", "dimensions")), "keys")
        .when(~F.coalesce(decision.isin(*DECISIONS), F.lit(False)), "decision")
        .when(~F.coalesce(F.size(reasons).between(1, REASONS) & sound, F.lit(False)), "reasons")
        .when(~same(keys("$.dimensions"), names(*DIMENSIONS)) | ~rated, "dimensions")
        .when(~agrees(decision, marks), "contradiction")
    )


def judgment(text: str) -> dict:
    """A checked judgment; ValueError, whatever its types, if it isn't one."""
    value = jsons.strict(text)
    if not isinstance(value, dict) or value.keys() != {"decision", "reasons", "dimensions"}:
        raise ValueError("keys")
    decision, reasons, marks = value["decision"], value["reasons"], value["dimensions"]
    control = lambda r: any(ord(c) == 127 or ord(c) < 32 and c not in "\n\t" for c in r)
    faults = {
        "decision": not isinstance(decision, str) or decision not in DECISIONS,
        "reasons": not isinstance(reasons, list) or not 1 <= len(reasons) <= REASONS or any(not isinstance(r, str) or not r.strip() or len(r) > REASON_CHARS or control(r) for r in reasons),
        "dimensions": not isinstance(marks, dict) or marks.keys() != {*DIMENSIONS} or any(not isinstance(m, str) or m not in RATINGS for m in marks.values()),
    }
    if found := [name for name, bad in faults.items() if bad]:
        raise ValueError(found[0])
    said = list(marks.values())
    if decision == "keep" and ("fail" in said or "uncertain" in said) or decision in ("repair", "drop") and "fail" not in said:
        raise ValueError("contradiction")
    return value


def human(decision: Column) -> Column:
    """A decision in people's words; null for none."""
    return F.coalesce(*(F.when(decision == k, v) for k, v in HUMAN.items()))


class Ledger:
    """Reservations before, charges after each request; a request whose end is unknown is never sent again.

    run() stops, and says why in `stopped`, when the next reservation is beyond the budget, when a charge is above its reservation, and when a
    request fails or its answer is no judgment: what was sent before that still counts.
    """

    def __init__(self, path: str, identity: str, budget: Decimal, largest: int = 100_000):
        self.db, self.budget, self.largest, self.stopped = sqlite3.connect(path, isolation_level=None), budget, largest, None
        self.db.execute("create table if not exists attempts (id text primary key, reservation text, charge text, request text, result text)")
        self.db.execute("create table if not exists meta (identity text)")
        known = self.db.execute("select identity from meta").fetchone()
        if known and known[0] != identity:
            raise ValueError("the ledger is of another run")
        if not known:
            self.db.execute("insert into meta values (?)", (identity,))
        self.committed = sum((Decimal(c if c is not None else r) for r, c in self.db.execute("select reservation, charge from attempts")), Decimal(0))

    def spent(self) -> Decimal:
        """Charges, and reservations of requests without one; kept as requests come and go."""
        return self.committed

    def run(self, rows: Iterable[tuple[str, str]], price: Decimal, send: Callable[[str], tuple[str, Decimal]], workers: int = 1) -> dict[str, dict]:
        """Judgments of (id, payload) rows by `send`, which returns text and cost; at most `workers` requests are under way, and rows are taken as they are needed."""
        tried = {i for (i,) in self.db.execute("select id from attempts")}
        left = (row for row in rows if row[0] not in tried)
        self.stopped, active = None, {}
        with concurrent.futures.ThreadPoolExecutor(workers) as pool:
            held = next(left, None)
            while held or active:
                while held and not self.stopped and len(active) < workers:
                    i, payload = held
                    raw = payload.encode()
                    if len(raw) > self.largest:
                        self.stopped = "request_too_large"
                    elif self.committed + price > self.budget:
                        if active:
                            break  # a charge may free what its reservation holds
                        self.stopped = "budget_exhausted"
                    else:
                        self.db.execute("insert into attempts values (?, ?, null, ?, null)", (i, str(price), hashlib.sha256(raw).hexdigest()))
                        self.committed += price
                        tried.add(i)
                        active[pool.submit(send, payload)] = i
                        held = next((row for row in left if row[0] not in tried), None)
                if not active:
                    break
                done, _ = concurrent.futures.wait(active, return_when=concurrent.futures.FIRST_COMPLETED)
                for future in done:
                    self._settle(active.pop(future), price, future)
        return self.results()

    def _settle(self, i: str, price: Decimal, future) -> None:
        try:
            text, cost = future.result()
        except Exception as error:  # the reservation stands: the request may have been charged
            result, cost = {"decision": None, "error": str(error)}, None
            self.stopped = "stopped_on_error"
        else:
            try:
                result = judgment(text)
            except (ValueError, RecursionError) as error:
                result = {"decision": None, "error": str(error)}
                self.stopped = "stopped_on_error"
            if cost > price:
                self.stopped = "charge_above_reservation"
            self.committed += cost - price
        self.db.execute("update attempts set charge = ?, result = ? where id = ?", (None if cost is None else str(cost), json.dumps(result, ensure_ascii=False), i))

    def results(self) -> dict[str, dict]:
        return {i: json.loads(r) for i, r in self.db.execute("select id, result from attempts where result is not null")}


