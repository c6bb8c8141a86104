"""Preparation of the source: local files or downloads, verified and frozen."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
from dataclasses import asdict, dataclass
from pathlib import Path

from corpusmill import __version__
from corpusmill.config import CONTRACT_VERSION, BuildConfig
from corpusmill.errors import SourceError
from corpusmill.sources.files import file_digests, published_sha1, read_json, write_json
from corpusmill.sources.http import Client, job_done, source_urls

AGENT = f"corpusmill/{__version__}"


@dataclass(frozen=True)
class Prepared:
    """The verified source of a build: places of dump and index, what is known of them, and the identity of the build."""

    dump: Path
    index: Path
    metadata: dict
    identity: str


def identity_of(metadata: dict, config: BuildConfig) -> str:
    """SHA-256 of what decides the content of checkpoints: source, split, texts and contract, not the number of workers."""
    value = {"source": metadata, "split": asdict(config.split), "site": config.site, "contract": CONTRACT_VERSION, "quarantine": config.quarantine}
    return hashlib.sha256(json.dumps(value, sort_keys=True).encode()).hexdigest()


def prepare(config: BuildConfig, client: Client | None = None) -> Prepared:
    """Verify the source and freeze the identity of the build in its work folder.

    Local files are taken as they are, with a checksum list or status beside
    them if the configuration names one; otherwise the snapshot must be done
    and its files match the published checksums.  A work folder frozen for
    another source is an error.
    """
    work = config.work_folder
    work.mkdir(parents=True, exist_ok=True)
    if config.dump and config.index:
        dump, index, published = config.dump.resolve(), config.index.resolve(), None
        if index.stat().st_size > config.max_index_bytes or dump.stat().st_size > config.max_dump_bytes:
            raise SourceError("a source file is larger than allowed")
    else:
        dump, index, published = _fetch(config, work, client)
    described = {}
    for name, path in (("dump", dump), ("index", index)):
        first, second, size = file_digests(path)
        stated = (published or {}).get(name, first)
        if stated != first:
            raise SourceError(f"the {name} does not match its published checksum")
        described[name] = {"sha1": first, "sha256": second, "bytes": size, "published_sha1": stated}
    if described["dump"]["bytes"] <= 0:
        raise SourceError("the dump is empty")
    metadata = {"wiki": config.wiki, "snapshot": config.snapshot, "license": config.license, "status": "done", **described}
    identity = identity_of(metadata, config)
    state = work / "run-state.json"
    if state.exists():
        if read_json(state, "the state of the run").get("identity") != identity:
            raise SourceError("the work folder belongs to another source or setting")
    else:
        write_json(state, {"identity": identity, "source": metadata})
    return Prepared(dump, index, metadata, identity)


def _fetch(config: BuildConfig, work: Path, client: Client | None):
    urls = source_urls(config.wiki, config.snapshot, config.base_url)
    with client or Client(AGENT, config.timeout) as web:
        status = json.loads(web.get(urls["status"], config.max_status_bytes))
        if not isinstance(status, dict) or not job_done(status):
            raise SourceError("the snapshot is not done")
        listed = web.get(urls["checksums"], config.max_status_bytes).decode("utf-8")
        published = {n: published_sha1(listed, urls[n].rpartition("/")[2]) for n in ("dump", "index")}
        places = {}
        for name, limit in (("index", config.max_index_bytes), ("dump", config.max_dump_bytes)):
            place = work / urls[name].rpartition("/")[2]
            if place.exists() and file_digests(place)[0] != published[name]:
                place.unlink()
            if not place.exists():
                part = place.with_suffix(place.suffix + ".part")
                part.unlink(missing_ok=True)
                if web.download(urls[name], part, limit)[0] != published[name]:
                    part.unlink()
                    raise SourceError(f"the {name} does not match its published checksum")
                os.replace(part, place)
            places[name] = place
    return places["dump"], places["index"], published


def copy_index(prepared: Prepared, target: Path) -> None:
    """Bundle the index with a dataset."""
    shutil.copyfile(prepared.index, target)
