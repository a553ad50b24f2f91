"""Tables as Parquet parts below a root that driver and executors share, each with its contract and its log beside it.

A table's log is a folder of numbered versions. Each version says which parts the table then has and which runs of which
load jobs are in it, so rows and the record that they went in become visible in one step. A version is a file that only one
writer can create: who comes second looks at the new version, makes its change again on top of that, and tries the next
number. Parts are written before they are named; those that no version names are never read.
"""

from __future__ import annotations

import fnmatch
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from tallyport.contract import TableContract
from tallyport.sources.files import Place

#: Times that a commit starts again because others were first.
ATTEMPTS = 100


class LostRace(RuntimeError):
    """Other writers were first again and again."""


@dataclass(frozen=True)
class Version:
    """A table's parts, and for each job the folders that say what its runs loaded."""

    number: int = 0
    parts: tuple[str, ...] = ()
    jobs: dict[str, list[str]] = field(default_factory=dict)

    def with_part(self, part: str) -> Version:
        return replace(self, parts=(*self.parts, part))

    def with_run(self, job: str, run: str) -> Version:
        return replace(self, jobs=self.jobs | {job: [*self.jobs.get(job, []), run]})


class Store:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, Place.of(root)

    def _home(self, schema: str, table: str) -> Place:
        return self.root / schema / table

    def _log(self, schema: str, table: str) -> Place:
        return self._home(schema, table) / "log"

    def contract(self, schema: str, table: str) -> TableContract:
        self.check_schema(schema)
        text = (self._home(schema, table) / "contract.json").read_text()
        if text is None:
            raise LookupError(f"there is no table {schema}.{table}")
        return TableContract.from_json(text)

    def check_schema(self, schema: str) -> None:
        """`public` is always there; any other schema once it has a table."""
        if schema != "public" and not (self.root / schema).names():
            raise LookupError(f"there is no schema {schema}")

    def create(self, contract: TableContract) -> bool:
        """Whether the table was made; an existing one stays as it is."""
        return (self._home(contract.schema, contract.table) / "contract.json").create(contract.to_json())

    def version(self, schema: str, table: str) -> Version:
        """The latest one."""
        numbers = [int(n.removesuffix(".json")) for n in self._log(schema, table).names() if n.endswith(".json") and not n.startswith(".")]
        if not numbers:
            return Version()
        raw = json.loads((self._log(schema, table) / f"{max(numbers):020}.json").read_text())
        return Version(raw["number"], tuple(raw["parts"]), raw["jobs"])

    def commit(self, schema: str, table: str, change: Callable[[Version], Version | None]) -> Version:
        """The version that `change` makes of the latest one. It is called again, with a newer one, if another writer was
        first; None leaves the table as it is."""
        for _ in range(ATTEMPTS):
            base = self.version(schema, table)
            wanted = change(base)
            if wanted is None:
                return base
            made = replace(wanted, number=base.number + 1)
            record = {"number": made.number, "parts": list(made.parts), "jobs": made.jobs}
            if (self._log(schema, table) / f"{made.number:020}.json").create(json.dumps(record)):
                return made
        raise LostRace(f"{ATTEMPTS} other versions of {schema}.{table} came first")

    def parts(self, schema: str, table: str) -> list[str]:
        return list(self.version(schema, table).parts)

    def read(self, schema: str, table: str, at: Version | None = None) -> DataFrame:
        """The table in its latest version or in the one given."""
        struct, home = self.contract(schema, table).struct(), self._home(schema, table)
        parts = (at or self.version(schema, table)).parts
        if not parts:
            return self.spark.createDataFrame([], struct)
        return self.spark.read.schema(struct).parquet(*((home / part).for_spark for part in parts))

    def write(self, schema: str, table: str, df: DataFrame) -> str:
        """A new part, which no version names yet."""
        part = f"part-{uuid.uuid4().hex}"
        df.write.parquet((self._home(schema, table) / part).for_spark)
        return part

    def append(self, schema: str, table: str, df: DataFrame) -> None:
        part = self.write(schema, table, df)
        self.commit(schema, table, lambda base: base.with_part(part))

    def replace(self, schema: str, table: str, df: DataFrame) -> None:
        part = self.write(schema, table, df)
        self.commit(schema, table, lambda base: replace(base, parts=(part,)))

    def tables(self, schemas: tuple[str, ...] = (), names: tuple[str, ...] = ()) -> list[tuple[str, str]]:
        """(schema, table) in order; filters are names or LIKE patterns (% and _)."""
        found = [(s, t) for s in self.root.names() if not s.startswith(".") for t in (self.root / s).names() if (self._home(s, t) / "contract.json").read_text() is not None]
        return sorted((s, t) for s, t in found if _like(s, schemas) and _like(t, names))


def _like(name: str, patterns: tuple[str, ...]) -> bool:
    glob = lambda p: "".join({"%": "*", "_": "?"}.get(c, f"[{c}]" if c in "*?[" else c) for c in p)
    return not patterns or any(name == p or fnmatch.fnmatchcase(name, glob(p)) for p in patterns)
