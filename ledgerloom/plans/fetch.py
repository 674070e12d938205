"""Fetching documents (SRC-04, SRC-05): one global rate limit, retries, and an injectable transport.

Fetching is bound by the archive's rate limit and therefore runs in one place,
whatever the size of the cluster; everything after it is distributed.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path

RETRIED = frozenset((429, 500, 502, 503, 504))
#: (url, headers, timeout) to (status, body). Raises OSError where the connection fails.
Transport = Callable[[str, dict[str, str], float], tuple[int, bytes]]


class NotFound(LookupError):
    pass


class FetchError(RuntimeError):
    pass


def folder_transport(root: str, prefix: str) -> Transport:
    """Serves addresses below `prefix` from files below `root`; anything else is not found."""

    def get(url: str, headers: dict[str, str], timeout: float) -> tuple[int, bytes]:
        path = Path(root) / url.removeprefix(prefix).lstrip("/")
        return (200, path.read_bytes()) if url.startswith(prefix) and path.is_file() else (404, b"")

    return get


def http_transport(url: str, headers: dict[str, str], timeout: float) -> tuple[int, bytes]:
    from urllib.error import HTTPError
    from urllib.request import Request, urlopen

    try:
        with urlopen(Request(url, headers=headers), timeout=timeout) as answer:  # follows redirects
            return answer.status, answer.read()
    except HTTPError as error:
        return error.code, b""


@dataclass
class Fetcher:
    user_agent: str
    transport: Transport = http_transport
    per_second: float = 5.0
    timeout: float = 30.0
    attempts: int = 3
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    _last: float | None = field(default=None, init=False)

    def get(self, url: str, missing_ok: bool = False) -> bytes | None:
        """The body; None for a missing (or forbidden) document where that is allowed."""
        problem: object = None
        for attempt in range(1, self.attempts + 1):
            self._wait()
            try:
                status, body = self.transport(url, {"User-Agent": self.user_agent, "Accept-Encoding": "identity"}, self.timeout)
            except OSError as error:
                status, body, problem = 0, b"", error
            if status == 200:
                return body
            if missing_ok and status in (403, 404):
                return None
            if status == 404:
                raise NotFound(url)
            if status and status not in RETRIED:
                raise FetchError(f"{url}: status {status}")
            problem = problem if not status else f"status {status}"
            if attempt < self.attempts:
                self.sleep(0.5 * attempt)
        raise FetchError(f"{url}: {problem}")

    def text(self, url: str) -> str:
        return (self.get(url) or b"").decode("utf-8", "replace")

    def json(self, url: str) -> object:
        return json.loads(self.get(url) or b"null")

    def _wait(self) -> None:
        now = self.clock()
        if self._last is not None and (left := self._last + 1 / self.per_second - now) > 0:
            self.sleep(left)
            now += left
        self._last = now
