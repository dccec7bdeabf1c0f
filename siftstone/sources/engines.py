"""Search engines as a Spark data source, objects in a store as a sink, and models kept by workers.

What needs a network is given as callables that can be pickled; partitions, pauses, tries, commits and caches are here.
"""

from __future__ import annotations

import gc
import logging
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

log = logging.getLogger(__name__)

# Seconds between two queries of an engine that wants pauses; results taken of a query.
PAUSE, RESULTS = 5.0, 20
#: Queries that one read plans for, each a partition or a part of one; the driver lists them.
MOST_QUERIES = 10_000


@dataclass(frozen=True)
class Engine:
    """find(query): URLs, best first. With a pause, queries of one group follow each other with so many seconds between."""

    name: str
    find: Callable[[str], list[str | None]]
    pause: float = 0.0
    most: int = RESULTS


@dataclass
class Registry:
    """Engines by name, in the order in which they were added, which is that of their results."""

    engines: dict[str, Engine] = field(default_factory=dict)

    def add(self, engine: Engine) -> Engine:
        if engine.name in self.engines:
            raise ValueError(f"there is an engine {engine.name} already")
        self.engines[engine.name] = engine
        return engine

    def chosen(self, names: list[str] | None = None) -> list[Engine]:
        """All, or those of names that are there, in the registry's order."""
        return [e for n, e in self.engines.items() if names is None or n in names]


@dataclass
class Asked(InputPartition):
    """Queries (poi, ord, query) that one engine is asked one after the other."""

    engine: Engine
    rank: int
    queries: list[tuple]


def partitions(engines: list[Engine], queries: list[tuple]) -> list[Asked]:
    """A partition a query; of an engine with pauses one a group (poi), as the pauses lie between its queries."""
    out: list[Asked] = []
    for rank, engine in enumerate(engines):
        if not engine.pause:
            out += [Asked(engine, rank, [q]) for q in queries]
            continue
        groups: dict[object, list[tuple]] = {}
        for q in queries:
            groups.setdefault(q[0], []).append(q)
        out += [Asked(engine, rank, g) for g in groups.values()]
    return out


def answers(part: Asked, sleep: Callable[[float], None] = time.sleep) -> Iterator[tuple]:
    """poi, ord, query, source, rank, url, nth. A query that fails has no answers, and the next is asked all the same."""
    for k, (poi, order, query) in enumerate(part.queries):
        if k and part.engine.pause:
            sleep(part.engine.pause)
        try:
            found = [u for u in part.engine.find(query)[: part.engine.most] if u]
        except Exception as error:
            log.warning("%s: %r failed: %s", part.engine.name, query, error)
            continue
        yield from ((poi, order, query, part.engine.name, part.rank, u, n) for n, u in enumerate(found))


def search_source(engines: list[Engine], queries: list[tuple[str, int, str]], sleep: Callable[[float], None] = time.sleep, name: str = "image_search") -> type[DataSource]:
    """A data source to be registered (spark.dataSource.register) and read by its name: what the engines answer."""
    if len(queries) > MOST_QUERIES:
        raise ValueError(f"more than {MOST_QUERIES} queries: read them in lots, or use plans.sourcing.search_all")

    class Reader(DataSourceReader):
        def partitions(self) -> list[InputPartition]:
            return partitions(engines, queries) or [Asked(Engine("none", lambda q: []), 0, [])]

        def read(self, partition: InputPartition) -> Iterator[tuple]:
            return answers(partition, sleep)

    class Search(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "poi string, ord int, query string, source string, rank int, url string, nth int"

        def reader(self, schema) -> DataSourceReader:
            return Reader()

    return Search


@dataclass(frozen=True)
class Store:
    """put(path, content, mime), exists(path), and done(uploaded, present) once all tasks have ended well."""

    put: Callable[[str, bytes, str], None]
    exists: Callable[[str], bool]
    done: Callable[[list[str], list[str]], None] = lambda uploaded, present: None


@dataclass
class Uploaded(WriterCommitMessage):
    uploaded: list[str]
    present: list[str]


def put_all(rows: Iterator, store: Store, tries: int = 3, wait: Callable[[int], None] = lambda k: None) -> Uploaded:
    """Rows (path, content, mime) into the store. What is there already is left alone, so a task or a job that runs again
    uploads nothing twice; if the last try fails and the object is there all the same, it was uploaded. Else the error is raised."""
    out = Uploaded([], [])
    for r in rows:
        if store.exists(r["path"]):
            out.present.append(r["path"])
            continue
        for k in range(tries):
            try:
                store.put(r["path"], bytes(r["content"]), r["mime"])
                break
            except Exception as error:
                log.warning("%s: try %d of %d: %s", r["path"], k + 1, tries, error)
                if k + 1 < tries:
                    wait(k)
                elif not store.exists(r["path"]):
                    raise
        out.uploaded.append(r["path"])
    return out


def upload_sink(store: Store, tries: int = 3, wait: Callable[[int], None] = lambda k: None, name: str = "object_store") -> type[DataSource]:
    """A data source to be registered and written to (mode append). A task reports what it put and what was there; commit hands
    both lists to store.done. A job that is aborted leaves its objects, which the next run finds there."""

    class Writer(DataSourceWriter):
        def write(self, iterator: Iterator) -> WriterCommitMessage:
            return put_all(iterator, store, tries, wait)

        def commit(self, messages: list[WriterCommitMessage | None]) -> None:
            some = [m for m in messages if m is not None]
            store.done(sorted(p for m in some for p in m.uploaded), sorted(p for m in some for p in m.present))

        def abort(self, messages: list[WriterCommitMessage | None]) -> None:
            log.warning("upload aborted after %d tasks", sum(m is not None for m in messages))

    class Sink(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "path string, content binary, mime string"

        def writer(self, schema, overwrite: bool) -> DataSourceWriter:
            return Writer()

    return Sink


#: What a Python worker has loaded: the model and how to unload it, by name.
_loaded: dict[str, tuple[object, Callable[[object], None] | None]] = {}
# Images that a model is given at once; the score of one that could not be scored.
AT_ONCE, UNSCORED = 16, 6.0


def model(name: str, load: Callable[[], object], unload: Callable[[object], None] | None = None) -> object:
    """The model of that name, loaded once a Python worker; those of other names are unloaded first, as a worker
    holds one at a time."""
    for other in [n for n in _loaded if n != name]:
        old, let_go = _loaded.pop(other)
        if let_go is not None:
            let_go(old)
        del old
        gc.collect()
    if name not in _loaded:
        _loaded[name] = (load(), unload)
    return _loaded[name][0]


def scored(content: Column, name: str, load: Callable[[], object], predict: Callable[[object, list[bytes]], list[float]], unload: Callable[[object], None] | None = None, at_once: int = AT_ONCE, unscored: float = UNSCORED) -> Column:
    """A model's score of each content, `at_once` together. Where a lot fails its members are scored one by one; one that fails
    alone, is null or gets no number has the score `unscored`, so that it stays. A model that can't be loaded is raised."""

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            held = model(name, load, unload)
            out = [unscored] * len(batch)
            there = [k for k, x in enumerate(batch) if x is not None]
            for at in range(0, len(there), at_once):
                lot = there[at : at + at_once]
                try:
                    got = predict(held, [bytes(batch.iloc[k]) for k in lot])
                    if len(got) != len(lot):
                        raise ValueError("a score is missing")
                except Exception as error:
                    log.warning("%s: a lot of %d failed: %s", name, len(lot), error)
                    got = [_alone(held, predict, bytes(batch.iloc[k]), unscored) for k in lot]
                for k, s in zip(lot, got, strict=True):
                    out[k] = unscored if s is None or s != s else float(s)
            yield pd.Series(out, dtype="float64")

    return run(content)


def _alone(held: object, predict: Callable[[object, list[bytes]], list[float]], content: bytes, unscored: float) -> float:
    try:
        return predict(held, [content])[0]
    except Exception as error:
        log.warning("not scored: %s", error)
        return unscored
