"""A small HTTP client with hard bounds, for the driver."""

from __future__ import annotations

import hashlib
import re
import urllib.error
import urllib.request
from pathlib import Path

from corpusmill.errors import SourceError

_CHUNK = 1 << 20


class Client:
    """Fetches with a time limit and never more than a caller allows.

    ``opener`` may be replaced by anything with ``open(request, timeout=...)``.
    """

    def __init__(self, agent: str, timeout: float = 60.0, opener=None):
        if not agent.strip():
            raise SourceError("a user agent must be named")
        self.agent, self.timeout = agent, timeout
        self.opener = opener or urllib.request.build_opener()

    def __enter__(self) -> Client:
        return self

    def __exit__(self, *_) -> None:
        close = getattr(self.opener, "close", None)
        if close:
            close()

    def _open(self, url: str, method: str = "GET", headers: dict | None = None):
        request = urllib.request.Request(url, method=method, headers={"User-Agent": self.agent, "Accept-Encoding": "identity"} | (headers or {}))
        try:
            return self.opener.open(request, timeout=self.timeout)
        except (urllib.error.URLError, OSError) as error:
            raise SourceError(f"{method} {url} failed: {error}") from error

    def length(self, url: str) -> int:
        """The declared length of a resource: stated, a whole number, above zero."""
        with self._open(url, "HEAD") as answer:
            return _declared(answer, url)

    def get(self, url: str, limit: int) -> bytes:
        """A whole resource of at most ``limit`` bytes, as declared and as received."""
        with self._open(url) as answer:
            declared = answer.headers.get("Content-Length")
            if declared is not None and _declared(answer, url) > limit:
                raise SourceError(f"{url} declares more than {limit} bytes")
            data = answer.read(limit + 1)
        if len(data) > limit:
            raise SourceError(f"{url} sends more than {limit} bytes")
        return data

    def get_range(self, url: str, start: int, end: int) -> bytes:
        """Exactly the bytes from ``start`` to ``end``, both included; the answer must be partial and name the same range."""
        if start < 0 or end < start:
            raise SourceError("a byte range is empty or negative")
        with self._open(url, headers={"Range": f"bytes={start}-{end}"}) as answer:
            if answer.status != 206:
                raise SourceError(f"{url} ignores the byte range")
            named = re.fullmatch(r"bytes (\d+)-(\d+)/(?:\d+|\*)", answer.headers.get("Content-Range", ""))
            if not named or (int(named[1]), int(named[2])) != (start, end):
                raise SourceError(f"{url} answers another byte range")
            data = answer.read(end - start + 2)
        if len(data) != end - start + 1:
            raise SourceError(f"{url} sends {'too many' if len(data) > end - start + 1 else 'too few'} bytes of the range")
        return data

    def download(self, url: str, target: Path, limit: int) -> tuple[str, str, int]:
        """Stream a resource into a new file; SHA-1, SHA-256 and size.  What was written is removed on failure."""
        first, second, size = hashlib.sha1(), hashlib.sha256(), 0
        with self._open(url) as answer:
            expected = _declared(answer, url) if answer.headers.get("Content-Length") is not None else None
            if expected is not None and expected > limit:
                raise SourceError(f"{url} declares more than {limit} bytes")
            try:
                with target.open("xb") as file:
                    while chunk := answer.read(_CHUNK):
                        size += len(chunk)
                        if size > limit:
                            raise SourceError(f"{url} sends more than {limit} bytes")
                        first.update(chunk)
                        second.update(chunk)
                        file.write(chunk)
                if expected is not None and size != expected:
                    raise SourceError(f"{url} ended after {size} of {expected} bytes")
            except FileExistsError:
                raise
            except BaseException:
                target.unlink(missing_ok=True)
                raise
        return first.hexdigest(), second.hexdigest(), size


def _declared(answer, url: str) -> int:
    text = answer.headers.get("Content-Length")
    if text is None or not re.fullmatch(r"[0-9]+", text.strip()) or int(text) <= 0:
        raise SourceError(f"{url} declares no usable length")
    return int(text)


def source_urls(wiki: str, snapshot: str, base_url: str | None = None) -> dict[str, str]:
    """Addresses of the dump, its index, checksums and status for a wiki and snapshot."""
    base = (base_url or f"https://dumps.wikimedia.org/{wiki}/{snapshot}").rstrip("/")
    stem = f"{wiki}-{snapshot}"
    return {
        "dump": f"{base}/{stem}-pages-articles-multistream.xml.bz2",
        "index": f"{base}/{stem}-pages-articles-multistream-index.txt.bz2",
        "checksums": f"{base}/{stem}-sha1sums.txt",
        "status": f"{base}/dumpstatus.json",
    }


def job_done(status: dict) -> bool:
    """Whether the status of a snapshot says that the articles job is done."""
    jobs = status.get("jobs")
    job = jobs.get("articlesmultistreamdump") if isinstance(jobs, dict) else None
    return isinstance(job, dict) and job.get("status") == "done"
