"""Changes of stored tables by runs that are killed between any two steps."""

import shutil

import pytest
from pyspark.sql import types as T

from funnelwright.schemas import TableSpec
from funnelwright.sinks import changefiles, exchange, keyfilters, tables

SPEC = TableSpec(
    "facts",
    T.StructType([T.StructField(n, T.StringType()) for n in ("id", "day")] + [T.StructField("n", T.LongType())]),
    keys=("id",),
    partition="day",
    cluster=("id",),
)
OLD = [("a", "d1", 1), ("b", "d1", 2), ("c", "d2", 3), ("d", "d3", 4)]


@pytest.fixture
def states(monkeypatch, tmp_path):
    """What a run that is killed leaves: copies of a folder before every write, move and removal of a change, and after it."""

    def of(root, change):
        found = []

        def copy():
            found.append(f"{tmp_path}/state{len(found)}")
            shutil.copytree(root, found[-1])

        with monkeypatch.context() as patch:
            for name in ("rename", "remove", "_write_text"):
                plain = getattr(exchange, name)

                def step(*args, plain=plain):
                    copy()
                    return plain(*args)

                patch.setattr(exchange, name, step)
            patch.setattr(tables, "_rename", exchange.rename)
            patch.setattr(tables, "remove", exchange.remove)
            change(root)
        copy()
        return found

    return of


@pytest.fixture(autouse=True)
def every_partition_is_searched(monkeypatch):
    """Key filters have tests of their own; without them a run takes a third of the time."""
    monkeypatch.setattr(keyfilters, "refresh", lambda *args: {})
    monkeypatch.setattr(keyfilters, "may_hold", lambda base, path, partition, keys, asked: sorted(keyfilters._listed(base, partition)))


def stored(spark, root):
    return sorted(tuple(r) for r in tables.read_table(spark, root, SPEC).collect())


def rows(spark, *data):
    return spark.createDataFrame(data, SPEC.schema)


def all_kills(spark, root, states, change, new):
    """Every state reads as the old or as the new rows, and the change may be repeated on it."""
    tables.rebuild(spark, root, SPEC, rows(spark, *OLD))
    left = states(root, change)
    seen = []
    for n, state in enumerate(left):
        found = stored(spark, state)
        assert found in (OLD, new), n
        seen.append(found == new)
    # the old rows up to one step, the new ones from there on
    assert len(left) > 5 and seen == sorted(seen) and set(seen) == {False, True}
    turn = seen.index(True)
    for n in {1, turn - 1, turn, len(left) - 2}:
        change(left[n])
        assert stored(spark, left[n]) == new
        hidden = ("_new", "_old", "_pending", "_exchange")
        assert not [name for name in exchange.names(spark, f"{left[n]}/facts") if name.startswith(hidden)]


def test_upsert_killed_at_every_step(spark, tmp_path, states):
    batch = rows(spark, ("a", "d2", 10), ("e", "d4", 5), ("d", "d1", 40))
    new = [("a", "d2", 10), ("b", "d1", 2), ("c", "d2", 3), ("d", "d1", 40), ("e", "d4", 5)]
    all_kills(spark, str(tmp_path / "root"), states, lambda root: tables.upsert(spark, root, SPEC, batch), new)


def test_replace_range_killed_at_every_step(spark, tmp_path, states):
    batch = rows(spark, ("x", "d3", 7))
    new = [("a", "d1", 1), ("b", "d1", 2), ("x", "d3", 7)]
    all_kills(spark, str(tmp_path / "root"), states, lambda root: tables.replace_range(spark, root, SPEC, batch, "d2"), new)


def test_compaction_killed_at_every_step(spark, tmp_path, states):
    batch = rows(spark, ("a", "d2", 10), ("e", "d4", 5))
    new = [("a", "d2", 10), ("b", "d1", 2), ("c", "d2", 3), ("d", "d3", 4), ("e", "d4", 5)]

    def change(root):
        tables.upsert_later(spark, root, SPEC, batch)
        tables.compact(spark, root, SPEC)

    all_kills(spark, str(tmp_path / "root"), states, change, new)


def test_contacts_killed_at_every_step(spark, tmp_path, states):
    first = spark.createDataFrame([("a", "1", "2024/01/02", "x")], "id string, updated_at string, created_path string, one string")
    second = spark.createDataFrame(
        [("a", "2", "2024/01/02", "y"), ("b", "1", "2024/01/03", "z")], "id string, updated_at string, created_path string, two string"
    )

    def read(root):
        names = tables._contact_columns(spark, f"{root}/contacts")
        kind = T.StructType([T.StructField(c, T.StringType()) for c in names])
        spec = TableSpec("contacts", kind, keys=("id",), partition="created_day")
        found = tables.read_table(spark, root, spec).collect()
        return sorted((r["id"], r["updated_at"], r["two"] if "two" in names else None) for r in found)

    old, new = [("a", "1", None)], [("a", "2", "y"), ("b", "1", "z")]
    root = str(tmp_path / "root")
    tables.write_contacts(spark, root, first)
    left = states(root, lambda root: tables.write_contacts(spark, root, second))
    seen = [read(state) for state in left]
    assert all(found in (old, new) for found in seen) and seen[0] == old and seen[-1] == new
    for state in (left[2], left[len(left) // 2]):
        tables.write_contacts(spark, state, second)
        assert read(state) == new


def test_a_record_names_what_it_moves(spark, tmp_path):
    root = str(tmp_path)
    tables.rebuild(spark, root, SPEC, rows(spark, *OLD))
    path = f"{root}/facts"
    new = exchange.new_folder(path)
    tables._write(rows(spark, ("z", "d1", 9)), new, SPEC, "overwrite")
    assert stored(spark, root) == OLD  # no record: the old rows
    exchange.commit(spark, path, new, ["day=d1"], ["day=d3"])
    assert stored(spark, root) == [("c", "d2", 3), ("z", "d1", 9)]
    assert not any(n.startswith("_") and n != "_SUCCESS" for n in exchange.names(spark, path))


def test_a_half_written_batch_of_changes_is_not_read(spark, tmp_path, states):
    root = str(tmp_path / "root")
    tables.rebuild(spark, root, SPEC, rows(spark, *OLD))
    left = states(root, lambda root: tables.upsert_later(spark, root, SPEC, rows(spark, ("a", "d9", 9))))
    new = [("a", "d9", 9), *OLD[1:]]
    seen = [stored(spark, state) for state in left]
    assert all(found in (OLD, new) for found in seen) and seen[0] == OLD and seen[-1] == new
    assert changefiles.batches(spark, f"{left[-1]}/facts")
