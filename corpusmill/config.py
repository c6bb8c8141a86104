"""Settings and their checks."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from pathlib import Path

from corpusmill.errors import ConfigError

SPLITS = ("train", "validation", "test")
#: Reasons for which a page is dropped, in alphabetical order.
DROP_REASONS = ("empty_text", "insufficient_text", "invalid_page", "markup_residue", "non_article_namespace", "redirect")
#: Version of the pipeline contract that manifests state.
CONTRACT_VERSION = 7
MIB = 1 << 20


@dataclass(frozen=True)
class SplitConfig:
    """Shares of the splits in ten-thousandths, and the seed of the assignment.

    Pass the seed of an existing corpus to reproduce its splits.
    """

    train: int = 9800
    validation: int = 100
    test: int = 100
    seed: str = "corpus-v1"

    def __post_init__(self):
        shares = (self.train, self.validation, self.test)
        if min(shares) < 0:
            raise ConfigError("a split share is negative")
        if sum(shares) != 10_000:
            raise ConfigError("the split shares do not add up to 10000")


@dataclass(frozen=True)
class BuildConfig:
    """Settings of a complete build; the defaults suit a dated dump of one wiki."""

    wiki: str
    snapshot: str
    output: Path
    work: Path | None = None
    dump: Path | None = None
    index: Path | None = None
    base_url: str | None = None
    site: str = "wikipedia.org"
    license: str = "CC-BY-SA-4.0"
    split: SplitConfig = field(default_factory=SplitConfig)
    workers: int = 4
    timeout: float = 120.0
    max_index_bytes: int = 128 * MIB
    max_dump_bytes: int = 64 * 1024 * MIB
    max_status_bytes: int = 16 * MIB
    max_segment_text_bytes: int = 1024 * MIB
    tokenizer: Path | None = None
    eos_token_id: int | None = None
    context_length: int = 1024
    sequences_per_shard: int = 4096
    near_sample: int = 5000
    keep_work: bool = False
    quarantine: bool = False
    fail_after: int | None = None

    def __post_init__(self):
        _check_wiki(self.wiki)
        if not re.fullmatch(r"\d{8}", self.snapshot):
            raise ConfigError("a build needs a dated snapshot of eight digits")
        if not 1 <= self.workers <= 64:
            raise ConfigError("workers must lie between 1 and 64")
        for name in ("timeout", "max_index_bytes", "max_dump_bytes", "sequences_per_shard", "near_sample"):
            if getattr(self, name) <= 0:
                raise ConfigError(f"{name} must be positive")
        if self.context_length <= 1:
            raise ConfigError("context_length must be above 1")
        if (self.tokenizer is None) != (self.eos_token_id is None):
            raise ConfigError("a tokenizer and its end token go together")
        if self.fail_after is not None and (self.fail_after <= 0 or self.workers != 1):
            raise ConfigError("failure injection needs a positive count and one worker")
        target, work = self.output.resolve(), self.work_folder
        if target == work or work.is_relative_to(target) or target.is_relative_to(work):
            raise ConfigError("work and output folders must be apart")

    @property
    def work_folder(self) -> Path:
        """The given work folder, or a hidden sibling of the output."""
        return (self.work or self.output.parent / f".{self.output.name}.work").resolve()


@dataclass(frozen=True)
class ProbeConfig:
    """Settings of a build of one segment."""

    wiki: str
    output: Path
    snapshot: str = "latest"
    ordinal: int = 0
    dump: Path | None = None
    index: Path | None = None
    base_url: str | None = None
    site: str = "wikipedia.org"
    license: str = "CC-BY-SA-4.0"
    split: SplitConfig = field(default_factory=SplitConfig)
    timeout: float = 60.0
    max_index_bytes: int = 128 * MIB
    max_segment_bytes: int = 64 * MIB
    tokenizer: Path | None = None
    eos_token_id: int | None = None
    context_length: int = 1024
    sequences_per_shard: int = 4096

    def __post_init__(self):
        _check_wiki(self.wiki)
        if not re.fullmatch(r"[A-Za-z0-9-]+", self.snapshot):
            raise ConfigError("a snapshot name holds letters, digits and hyphens")
        if self.ordinal < 0:
            raise ConfigError("a segment number is not negative")
        for name in ("timeout", "max_index_bytes", "max_segment_bytes", "context_length", "sequences_per_shard"):
            if getattr(self, name) <= 0:
                raise ConfigError(f"{name} must be positive")
        if (self.tokenizer is None) != (self.eos_token_id is None):
            raise ConfigError("a tokenizer and its end token go together")


def _check_wiki(wiki: str) -> None:
    if not re.fullmatch(r"[a-z][a-z0-9_-]*wiki", wiki):
        raise ConfigError("a wiki is named by its language and the ending wiki")
