"""Asking a judge's REST interface: paced, retried, page by page. Driver code."""

from __future__ import annotations

import json
import threading
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from typing import Any

#: Seconds before the first retry, and at most.
FIRST_WAIT, LONGEST_WAIT = 5.0, 300.0

Fetch = Callable[[str, float], tuple[int, str]]


class JudgeError(Exception):
    """The interface refused a request."""


class NotFound(JudgeError):
    """It knows no such name."""


class Limited(JudgeError):
    """It still says that there are too many calls."""


class Unavailable(JudgeError):
    """It could not be reached, or not at present."""


class Pace:
    """At least ``interval`` seconds between any two calls of wait(), from all
    threads together."""

    def __init__(self, interval: float, *, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> None:
        if interval <= 0:
            raise ValueError(f"an interval of {interval} seconds")
        self.interval, self._clock, self._sleep = interval, clock, sleep
        self._next, self._lock = float("-inf"), threading.Lock()

    def wait(self) -> None:
        with self._lock:
            ahead = self._next - self._clock()
            if ahead > 0:
                self._sleep(ahead)
            self._next = self._clock() + self.interval


def over_http(url: str, timeout: float) -> tuple[int, str]:
    try:
        with urllib.request.urlopen(url, timeout=timeout) as answer:  # noqa: S310
            return answer.status, answer.read().decode()
    except urllib.error.HTTPError as e:
        return e.code, e.read().decode("utf-8", "replace")


class Judge:
    """Methods of the interface. ``fetch`` may be replaced, as in tests."""

    def __init__(self, base: str, pace: Pace, *, timeout: float = 60.0, tries: int = 10, fetch: Fetch = over_http, sleep: Callable[[float], None] = time.sleep) -> None:
        self.base, self.pace, self.timeout, self.tries, self._fetch, self._sleep = base.rstrip("/"), pace, timeout, tries, fetch, sleep

    def ask(self, method: str, **params: Any) -> Any:
        """The result of a method. What may pass is tried again, after twice the
        time at each turn: no connection, too many calls, errors of the server."""
        url = f"{self.base}/{method}?{urllib.parse.urlencode({k: v for k, v in params.items() if v is not None})}"
        wait, failed = FIRST_WAIT, Unavailable("not tried")
        for left in range(self.tries - 1, -1, -1):
            self.pace.wait()
            try:
                failed = self._answer(*self._fetch(url, self.timeout))
            except OSError as e:
                failed = Unavailable(f"transport: {e}")
            if not isinstance(failed, JudgeError):
                return failed[0]
            if type(failed) not in (Limited, Unavailable):
                raise failed
            if left:
                self._sleep(wait)
                wait = min(2 * wait, LONGEST_WAIT)
        raise failed

    @staticmethod
    def _answer(status: int, body: str) -> JudgeError | tuple[Any]:
        try:
            said = json.loads(body)
        except ValueError:
            said = None
        if isinstance(said, dict) and said.get("status") == "OK":
            return (said["result"],)
        comment = str(said.get("comment", "")) if isinstance(said, dict) else body[:200]
        text = comment or f"HTTP {status}"
        for words, kind in (("not found", NotFound), ("call limit exceeded", Limited), ("temporarily unavailable", Unavailable)):
            if words in comment.lower():
                return kind(text)
        return Unavailable(text) if status >= 500 or status == 403 else JudgeError(text)

    def rated_users(self, *, active: bool = True, retired: bool = False) -> list[dict]:
        return self.ask("user.ratedList", activeOnly=str(active).lower(), includeRetired=str(retired).lower())

    def problemset(self, name: str | None = None) -> dict:
        """Problems and statistics of the main set, or of a named one."""
        return self.ask("problemset.problems", problemsetName=name)

    def attempts(self, handle: str, page: int) -> Iterator[list[dict]]:
        """All attempts of a user, newest first, in pages; a short page ends."""
        at = 1
        while True:
            rows = self.ask("user.status", handle=handle, **{"from": at, "count": page})
            yield rows
            if len(rows) < page:
                return
            at += len(rows)
