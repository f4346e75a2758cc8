import datetime as dt

import pytest

from pyspark.sql import functions as F

from postalspark.functions.text import iso_timestamp, mask_url
from postalspark.operators import store as st
from postalspark.schemas import ADDRESS
from postalspark.session import scratch_dir
from postalspark.sinks.commits import CommitConflict
from postalspark.sinks.table import AddressTable, declare_tables, drop_tables, load_table, merge_into_declared

T0 = dt.datetime(2024, 1, 1)


def addr(spark, rows):
    full = [(c, l, None, "Bela Vista", "São Paulo", "SP", "3550308", None, "11", None, T0, T0) for c, l in rows]
    return spark.createDataFrame(full, ADDRESS)


def src(spark, rows):
    return spark.createDataFrame(rows, "cep string, logradouro string, complemento string, bairro string, "
                                       "localidade string, uf string, ibge string, gia string, ddd string, siafi string")


def test_insert_and_update(spark):
    target = addr(spark, [("01310100", "Avenida Paulista"), ("01001900", "Praça da Sé")])
    source = src(spark, [("01310100", "Avenida Paulista Updated", None, None, "São Paulo", "SP", None, None, None, None),
                         ("20040020", "Rua Nova", None, None, "Rio", "RJ", None, None, None, None)])
    out = {r.cep: r for r in st.merge_addresses(target, source, "2024-02-01 00:00:00").collect()}
    assert out["01310100"].logradouro == "Avenida Paulista Updated"
    assert out["01310100"].bairro is None  # every field replaced, NULLs included
    assert out["01310100"].created_at == T0 and out["01310100"].updated_at == dt.datetime(2024, 2, 1)
    assert out["01001900"].logradouro == "Praça da Sé" and out["01001900"].updated_at == T0
    assert out["20040020"].created_at == dt.datetime(2024, 2, 1)


def test_batch_upsert_last_record_wins(spark):
    target = addr(spark, [])
    source = spark.createDataFrame([(1, "01310100", "A"), (3, "01310100", "C"), (2, "01310100", "B")],
                                   "seq int, cep string, logradouro string")
    for f in ["complemento", "bairro", "localidade", "uf", "ibge", "gia", "ddd", "siafi"]:
        source = source.withColumn(f, F.lit(None).cast("string"))
    out = st.upsert_batch(target, source, "2024-02-01 00:00:00").collect()
    assert [(r.cep, r.logradouro) for r in out] == [("01310100", "C")]


def test_point_state_city_reads(spark):
    t = addr(spark, [("01310100", "Avenida Paulista"), ("01001900", "Praça da Sé")])
    assert st.address_by_code(t, "01310-100").first().logradouro == "Avenida Paulista"
    assert st.address_by_code(t, "0131 0100").count() == 1
    assert st.addresses_by_uf(t, "sp").count() == 2
    assert st.addresses_by_uf(t, "sp", limit=1).first().cep == "01001900"
    assert st.addresses_by_city(t, "São Paulo").count() == 2
    assert st.addresses_by_city(t, "são paulo").count() == 0
    assert st.count_addresses(t).first().total == 2


def test_split_insert_update(spark):
    t = addr(spark, [("01310100", "A")])
    inc = spark.createDataFrame([("01310100",), ("99999999",)], "cep string")
    assert {r.cep: r.action for r in st.split_insert_update(t, inc).collect()} == \
        {"01310100": "update", "99999999": "insert"}


def street(spark, *rows):
    return src(spark, [(c, l, None, None, "São Paulo", "SP", None, None, None, None) for c, l in rows])


def test_versioned_table_commit_and_replay(spark):
    table = AddressTable(spark, scratch_dir(spark, "table"))
    assert table.read().count() == 0 and table.current_version() == 0
    assert table.upsert(street(spark, ("01310100", "A"), ("01310200", "X")), "2024-01-01 00:00:00", 0, "ckpt") == 2
    s2 = street(spark, ("01310100", "B"))
    table.upsert(s2, "2024-01-02 00:00:00", 1, "ckpt")
    assert table.current_version() == 2 and table.progress("ckpt").batch == 1
    assert table.upsert(s2, "2024-01-03 00:00:00", 1, "ckpt") == 0  # replayed batch: no-op
    got = {r.cep: (r.logradouro, r.created_at, r.updated_at) for r in table.read().collect()}
    assert got == {"01310100": ("B", T0, dt.datetime(2024, 1, 2)), "01310200": ("X", T0, T0)}
    assert {r.cep: r.logradouro for r in table.read(1).collect()}["01310100"] == "A"  # old version untouched


def test_a_new_stream_on_an_old_table_loses_nothing(spark):
    table = AddressTable(spark, scratch_dir(spark, "table"))
    table.upsert(street(spark, ("01310100", "A")), "2024-01-01 00:00:00", 5, "old")
    assert table.upsert(street(spark, ("01310200", "B")), "2024-01-02 00:00:00", 0, "new") == 1
    assert sorted(r.cep for r in table.read().collect()) == ["01310100", "01310200"]


def test_crash_before_the_commit_file_leaves_the_table_as_it_was(spark, monkeypatch):
    table = AddressTable(spark, scratch_dir(spark, "table"))
    table.upsert(street(spark, ("01310100", "A")), "2024-01-01 00:00:00", 0, "s")

    def crash(*_):
        raise OSError("lost")

    monkeypatch.setattr(AddressTable, "_publish", crash)
    try:
        table.upsert(street(spark, ("01310100", "B")), "2024-01-02 00:00:00", 1, "s")
    except OSError:
        pass
    monkeypatch.undo()
    assert [r.logradouro for r in table.read().collect()] == ["A"]
    assert table.upsert(street(spark, ("01310100", "B")), "2024-01-02 00:00:00", 1, "s") == 1  # the replay
    assert [r.logradouro for r in table.read().collect()] == ["B"]


def test_a_number_is_taken_once(spark):
    table = AddressTable(spark, scratch_dir(spark, "table"))
    table.upsert(street(spark, ("01310100", "A")), "2024-01-01 00:00:00")
    old = table.state()
    table.upsert(street(spark, ("01310200", "B")), "2024-01-01 00:00:00")
    with pytest.raises(CommitConflict):
        table._publish(old, [])
    assert table.read().count() == 2 and not [f for f in table._commits.fs.listStatus(table._commits.path(table._commits.where))
                                              if f.getPath().getName().startswith(".0")]


def leafy(spark, n=200, leaf_rows=25):
    table = AddressTable(spark, scratch_dir(spark, "table"), leaf_rows=leaf_rows)
    table.commit(addr(spark, [(f"{i:08d}", "A") for i in range(n)]))
    return table


def test_only_files_with_incoming_codes_are_written_and_old_files_go(spark):
    table = leafy(spark)
    before = table.state().leaves
    table.upsert(street(spark, ("00000007", "B")), "2024-01-02 00:00:00")
    after = table.state().leaves
    assert len(before) >= 8 and len({f.path for f in before} - {f.path for f in after}) == 1
    assert table.read().count() == table.count() == 200
    table.upsert(street(spark, ("00000007", "C")), "2024-01-03 00:00:00")
    assert len(table.remove_old(1)) == 2
    assert table.read().where("logradouro <> 'A'").first().logradouro == "C" and table.read().count() == 200


def test_leaves_stay_disjoint_sorted_and_bounded(spark):
    import random
    rnd, table, want = random.Random(5), AddressTable(spark, scratch_dir(spark, "table"), leaf_rows=20), {}
    for step in range(5):
        rows = {f"{rnd.choice([rnd.randrange(100), rnd.randrange(10**8)]):08d}": f"s{step}" for _ in range(60)}
        want |= rows
        table.upsert(street(spark, *rows.items()), "2024-01-01 00:00:00")
        leaves = table.state().leaves
        assert all(f.low <= f.high and f.rows <= 20 for f in leaves)
        assert all(a.high < b.low for a, b in zip(leaves, leaves[1:], strict=False))
        assert {r.cep: r.logradouro for r in table.read().collect()} == want


def files_of(df):
    return df.inputFiles()


def test_a_point_read_opens_one_file(spark):
    table = leafy(spark)
    got = table.lookup("00000-042")
    assert [r.cep for r in got.collect()] == ["00000042"] and len(files_of(got)) == 1
    assert table.lookup("99999999").count() == 0 and table.lookup("").count() == 0


def test_a_page_opens_only_its_files_and_numbers_nothing(spark):
    table = leafy(spark)
    for limit, offset in ((10, 0), (30, 17), (1, 199), (None, 190), (0, 5), (500, 150), (10, 200), (10, 10**6)):
        got = table.page(limit, offset)
        end = offset + limit if limit else 200
        assert [r.cep for r in got.collect()] == [f"{i:08d}" for i in range(200)][offset:end]
        if 0 < len(range(offset, min(end, 200))) <= 30:
            assert len(files_of(got)) <= 3
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "Checkpoint" not in plan and "SinglePartition" not in plan


def racing(monkeypatch, table, others):
    """Let other writers commit just before this one's first tries."""
    publish, left = AddressTable._publish, list(others)

    def late(self, *a, **k):
        if self is table and left:
            left.pop(0)()
        return publish(self, *a, **k)

    monkeypatch.setattr(AddressTable, "_publish", late)


@pytest.mark.parametrize("mine,theirs", [("00000007", "00000190"), ("00000007", "00000008"), ("00000007", "00000007"), ("00000007", "x new")])
def test_two_writers_both_end_in_the_table(spark, monkeypatch, mine, theirs):
    table = leafy(spark)
    other = AddressTable(spark, table.root, leaf_rows=25)
    racing(monkeypatch, table, [lambda: other.upsert(street(spark, (theirs, "theirs")), "2024-01-02 00:00:00")])
    merges = []
    merge = AddressTable._merge
    monkeypatch.setattr(AddressTable, "_merge", lambda self, state, rows, now: merges.append((self is table, rows.count())) or merge(self, state, rows, now))
    assert table.upsert(street(spark, (mine, "mine"), ("00000100", "mine")), "2024-01-03 00:00:00") == 2
    got = {r.cep: r.logradouro for r in table.read().where("logradouro <> 'A'").collect()}
    assert got == {theirs: "theirs"} | {mine: "mine", "00000100": "mine"}
    assert table.count() == table.read().count() == 200 + (theirs == "x new")
    # what the other one did not replace is not merged again
    assert [n for own, n in merges if own] == [2, 1 if theirs in ("00000007", "00000008") else 0]


def test_first_writers_race_and_a_replaced_table(spark, monkeypatch):
    root = scratch_dir(spark, "table")
    table, other = AddressTable(spark, root), AddressTable(spark, root)
    racing(monkeypatch, table, [lambda: other.upsert(street(spark, ("5", "five")), "2024-01-02 00:00:00"),
                                lambda: other.commit(addr(spark, [("7", "seven")]))])
    table.upsert(street(spark, ("1", "one"), ("9", "nine")), "2024-01-03 00:00:00")
    assert {r.cep: r.logradouro for r in table.read().collect()} == {"1": "one", "7": "seven", "9": "nine"}


def test_attached_rows_show_with_their_commit_only(spark):
    table = AddressTable(spark, scratch_dir(spark, "table"))
    for i in range(4):
        name = table.attach(spark.createDataFrame([(i,)], "n int"))
        assert table.attached("errors", "n int").count() == i
        table.upsert(street(spark, (f"{i}", "A")), "2024-01-01 00:00:00", i, "s", attached={"errors": name})
    assert sorted(r.n for r in table.attached("errors", "n int").collect()) == [0, 1, 2, 3]
    table.remove_old(1)
    assert sorted(r.n for r in table.attached("errors", "n int").collect()) == [0, 1, 2, 3] and table.progress("s").batch == 3


def test_declared_table(spark):
    name = "ceps_test_table"
    drop_tables(spark, name)
    declare_tables(spark, name, scratch_dir(spark, "ddl"))
    load_table(addr(spark, [("01310100", "Avenida Paulista")]), name)
    types = dict(spark.table(name).dtypes)
    assert types["cep"] == "string" or types["cep"].startswith("varchar")
    assert spark.table(name).where("uf = 'SP'").count() == 1
    drop_tables(spark, name)


def test_export_row_times(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 7, 179575),), (dt.datetime(2024, 1, 1),)], "t timestamp_ntz")
    assert [r[0] for r in df.select(iso_timestamp("t")).collect()] == \
        [dt.datetime(2024, 1, 1, 0, 0, 7, 179575).isoformat(), dt.datetime(2024, 1, 1).isoformat()]


def test_mask_url(spark):
    def py_mask(url):
        if "@" in url:
            parts = url.split("@")
            if "://" in parts[0] and ":" in parts[0]:
                return parts[0].rsplit(":", 1)[0] + ":***@" + "@".join(parts[1:])
        return url
    urls = ["postgresql://user:secret@localhost:5432/db", "postgresql://reader@db:5432/x", "http://h/x",
            "amqp://guest:guest@q:5672/", "a@b", "x://u:p@h@i"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in df.select(mask_url("u")).collect()] == [py_mask(u) for u in urls]


def test_bucketed_declared_table(spark):
    name = "ceps_bucketed_test"
    drop_tables(spark, name)
    declare_tables(spark, name, scratch_dir(spark, "ddl_b"), buckets=4)
    load_table(addr(spark, [("01310100", "Avenida Paulista"), ("01001900", "Praça da Sé")]), name)
    info = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    assert info.get("Num Buckets") == "4" and "cep" in info.get("Bucket Columns", "")
    assert spark.table(name).count() == 2
    drop_tables(spark, name)


def test_reads_of_the_stored_table_reach_the_scan(spark, sf_small):
    from postalspark.plans.catalog import QUERIES, registered
    registered()
    plan = lambda name: QUERIES[name](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(uf" in plan("F5_addresses_by_uf")
    assert "EqualTo(localidade" in plan("F6_addresses_by_city") and "EqualTo(cep" in plan("F4_address_by_code")
    assert "SinglePartition" not in plan("S5_scan_addresses")


def test_a_bucketed_load_writes_a_file_per_bucket_not_per_task(spark):
    import uuid
    name, place = f"ceps_{uuid.uuid4().hex[:8]}", scratch_dir(spark, "ddl_f")
    declare_tables(spark, name, place, buckets=4)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    had = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        load_table(addr(spark, [(f"{i:08d}", "A") for i in range(400)]), name)
    finally:
        spark.conf.set(key, had)
    stored = spark.table(name)
    assert stored.count() == 400
    assert len(stored.inputFiles()) <= 4 * stored.select("uf").distinct().count()
    drop_tables(spark, name)


def test_merge_into_the_declared_bucketed_table(spark):
    name = "ceps_merge_test"
    drop_tables(spark, name)
    declare_tables(spark, name, scratch_dir(spark, "ddl_m"), buckets=4)
    load_table(addr(spark, [(f"{i:08d}", "A") for i in range(100)]), name)
    # the target's side of the join is read by its buckets: the only exchanges are the source's
    merged = st.merge_addresses(spark.table(name), st.last_rows(street(spark, ("00000007", "B"))).repartition(4, "cep"), "2024-01-02 00:00:00")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = merged.select("cep")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    target = next(part for part in plan.split("+- ") if "FileScan" in part)
    assert "Bucketed: true" in target
    join = plan[plan.index("Join"):]
    lines = [x for x in join.splitlines() if "FileScan" in x or "Exchange" in x]
    scan = next(x for x in lines if "FileScan" in x)
    above = [x for x in lines if "Exchange" in x and x.index("Exchange") < scan.index("FileScan") and lines.index(x) < lines.index(scan)]
    assert not above, plan
    places = {merge_into_declared(spark, name, street(spark, ("00000007", "B"), ("99999999", "new")), "2024-01-02 00:00:00"),
              merge_into_declared(spark, name, street(spark, ("00000007", "C"), ("00000007", "B")), "2024-01-03 00:00:00")}
    got = {r.cep: (r.logradouro, r.created_at, r.updated_at) for r in spark.table(name).collect()}
    assert len(places) == 2 and len(got) == 101
    assert got["00000007"] == ("C", T0, dt.datetime(2024, 1, 3)) and got["00000001"] == ("A", T0, T0)
    assert got["99999999"] == ("new", dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2))
    info = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    assert info["Num Buckets"] == "4"
    # a swap that was cut off after its first step
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__new")
    merge_into_declared(spark, name, street(spark, ("00000001", "D")), "2024-01-04 00:00:00")
    assert spark.table(name).count() == 101 and spark.table(name).where("cep = '00000001'").first().logradouro == "D"
    drop_tables(spark, name)
    declare_tables(spark, name, scratch_dir(spark, "ddl_n"))
    with pytest.raises(ValueError, match="buckets"):
        merge_into_declared(spark, name, street(spark, ("1", "A")), "2024-01-02 00:00:00")
    drop_tables(spark, name)
