"""Token files, mixing and shards."""

import os
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from loglathe.llm.mixing import MIX_SQL, mix_sources, mixed, size_in_words
from loglathe.llm.sharding import SLOTS, SlotMaps, edit_slot_map, numbered_copies, place_records, shard_documents, slot_weights
from loglathe.llm.token_files import BLOCK_IDS, TokenReader, TokenWriter, pack, token_table, unpack
from rows import ODD, words


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 31, 32])
def test_packing_round_trip(bits, tmp_path):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 2 * BLOCK_IDS + 77, dtype=np.uint64).astype(np.uint32)
    assert (unpack(pack(ids, bits), len(ids), bits) == ids).all()
    path = str(tmp_path / "x.tok")
    writer = TokenWriter(path, bits)
    cuts = [0, 0, 5, BLOCK_IDS + 3, BLOCK_IDS + 3, len(ids) - 1, len(ids)]
    for n, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        writer.add(None if n == 2 else n * 7, ids[a:b])
    writer.close()
    reader = TokenReader(path)
    order = random.Random(1).sample(range(len(cuts) - 1), len(cuts) - 1)
    assert all((reader.ids(n) == ids[cuts[n] : cuts[n + 1]]).all() for n in order)
    assert reader.nulls.tolist() == [n == 2 for n in range(6)] and reader.doc_ids[3] == 21
    assert os.path.getsize(path) < len(ids) * bits / 8 + 400
    with open(path, "rb+") as f:
        f.truncate(os.path.getsize(path) - 1)
    with pytest.raises(ValueError, match="cut off"):
        TokenReader(path)


def test_tokens_equal_the_tokenizer(table_of):
    from tokenizers import Tokenizer

    import public_tokenizers

    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(6)
    pieces = ["it's", "Don't", "x1y22", "<|endoftext|>", "é", "É", "́", " ", "\x1c", "\x85", "日本", "\U0001f600", "a" * 300, "--", "\t", "\n", "\r\n", "İI", "ΟΔΟΣ", " "]
    rows = [(i, "".join(rng.choice(pieces) + rng.choice(["", " ", "\n"]) for _ in range(30))) for i in range(60)]
    rows = rows + ODD
    got = token_table(table_of(rows).withColumn("part", F.lit("clash"))).collect()
    assert len(got) == len(rows)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    at = 0
    for row, (doc_id, text) in zip(sorted(got, key=lambda r: r["start"]), order, strict=True):
        ids = np.array([*model.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        assert (row["doc_id"], row["start"], row["n_tokens"], row["ids_crc32"]) == (doc_id, at, len(ids), zlib.crc32(ids.tobytes())), repr(text)
        at += len(ids)
    assert token_table(table_of([])).collect() == []


def mix_rows(seed, n):
    rng = random.Random(seed)
    return [(i, " ".join(["w"] * rng.choice((0, 1, 5, 40, 41, 300))), rng.choice(["b", "a", "é", None, "c", "a", "a", "a"])) for i in range(n)]


def targets(rows):
    """By sharing again and again what the caps leave over."""
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(words(text))
    names = sorted([s for s in sizes if s is not None], key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, open_ones, left = {}, set(names), 1.5 * sum(sizes.values())
    while open_ones:
        per = left / sum(weight[s] for s in open_ones)
        full = {s for s in open_ones if per * weight[s] > 2 * sizes[s]}
        if not full:
            return target | {s: per * weight[s] for s in open_ones}, sizes
        target |= {s: 2.0 * sizes[s] for s in full}
        left -= sum(2 * sizes[s] for s in full)
        open_ones -= full
    return target, sizes


@pytest.mark.parametrize("n", [7, 60, 900])
def test_mix_meets_its_targets(table_of, n):
    rows = mix_rows(n, n)
    wanted, sizes = targets(rows)
    got = mix_sources(table_of(rows), size_in_words(F.col("text"))).select("row.*", "size", "source_size", "target", "copies").collect()
    taken = defaultdict(int)
    for r in got:
        assert r["size"] == len(words(r["text"])) and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(wanted[r["source"]]) and 0 <= r["copies"] <= 2
        taken[r["source"]] += r["copies"] * r["size"]
    assert all(abs(taken[s] - wanted[s]) <= 300 for s in wanted)
    docs = table_of(rows, 5)
    again = Counter(r["doc_id"] for r in mixed(docs).collect())
    assert again == Counter({r["doc_id"]: r["copies"] for r in got if r["copies"]})
    assert mixed(docs).columns == docs.columns


def test_mix_equals_sql_on_odd_rows(table_of):
    rows = [(i, t, (None, "x")[n % 2]) for n, (i, t) in enumerate(ODD)]
    got = mix_sources(table_of(rows).withColumn("size", F.lit("clash")), size_in_words(F.col("text")))
    got = [(r["row"]["doc_id"], r["size"], r["source_size"], r["target"], r["size"] * r["copies"]) for r in got.collect()]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    assert sorted(got, key=str) == sorted(con.execute(MIX_SQL).fetchall(), key=str)
    assert mix_sources(table_of([]), F.lit(1).cast("long")).collect() == []
    assert {r["copies"] for r in mix_sources(table_of([(1, ""), (2, None)]), size_in_words(F.col("text"))).collect()} == {0}


def test_shards(table_of):
    rng = random.Random(8)
    rows = [(i, "ü" * rng.randrange(0, 400)) for i in range(100, 3100)] + ODD
    got = shard_documents(table_of(rows).withColumn("vslot", F.lit(1)), 40).collect()
    assert len(got) == len(rows)
    loads, places = Counter(), defaultdict(list)
    text = {i: t or "" for i, t in rows}
    for r in got:
        loads[r["shard"]] += r["size"]
        places[r["shard"]].append(r["slot"])
        if r["doc_id"] is not None:
            raw = text[r["doc_id"]].encode()
            assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 16, zlib.crc32(raw), "bytes") and r["grown_shard"] is None
    assert set(loads) == set(range(40)) and max(loads.values()) < 1.01 * min(loads.values())
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert shard_documents(table_of([]), 40).collect() == []


def test_editing_a_map_moves_little(spark):
    weights = spark.range(SLOTS).select(F.col("id").cast("int").alias("vslot"), (F.col("id") % 97 + 50).alias("bytes"), F.lit(1).cast("long").alias("records")).cache()
    first = edit_slot_map(weights, 40).cache()
    grown = edit_slot_map(weights, 41, first).cache()
    closed = edit_slot_map(weights, 39, first).cache()
    maps = [{r["vslot"]: r["shard"] for r in m.collect()} for m in (first, grown, closed)]
    size = {r["vslot"]: r["bytes"] for r in weights.collect()}
    for m, n in zip(maps, (40, 41, 39), strict=True):
        loads = Counter()
        for slot, shard in m.items():
            loads[shard] += size[slot]
        assert set(loads) == set(range(n)) and max(loads.values()) < 1.01 * min(loads.values())
    moved = [sum(size[s] for s in m if m[s] != maps[0][s]) / sum(size.values()) for m in maps[1:]]
    assert moved[0] < 1.2 / 41 and moved[1] < 1.2 / 40
    assert {r["version"] for r in first.collect()} == {1} and {r["version"] for r in grown.collect()} == {2}


def test_one_hot_id_and_equal_rows_are_spread(table_of):
    rng = random.Random(9)
    rows = [(i, "x" * rng.randrange(0, 300)) for i in range(4000)]
    rows += [(None, "n" * rng.randrange(0, 300)) for _ in range(3000)] + [(77, "the same")] * 3000
    got = shard_documents(table_of(rows), 40).collect()
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((i, len(t) + 16) for i, t in rows)
    loads, places = Counter(), defaultdict(list)
    for r in got:
        loads[r["shard"]] += r["size"]
        places[r["shard"]].append(r["slot"])
    assert len(loads) == 40 and max(loads.values()) < 1.01 * min(loads.values())
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_maps_hold_all_slots_and_versions_follow_each_other(spark, table_of, tmp_path):
    maps = SlotMaps(spark, str(tmp_path / "maps"))
    rng = random.Random(3)
    first = [(i, "a" * rng.randrange(50, 300)) for i in range(3000)]
    shard_documents(table_of(first), 10, maps).collect()
    one = {r["vslot"]: r["shard"] for r in maps.newest().collect()}
    assert set(one) == set(range(SLOTS))
    other = [(i, "b" * rng.randrange(50, 300)) for i in range(5000, 9000)]
    got = shard_documents(table_of(other), 11, maps).collect()
    two = {r["vslot"]: r["shard"] for r in maps.newest().collect()}
    assert set(two) == set(range(SLOTS)) and len(got) == 4000
    assert {r["version"] for r in maps.newest().collect()} == {2}
    assert sum(one[v] == two[v] for v in one) > 0.5 * SLOTS
    empty = {r["vslot"] for r in maps.newest().where("bytes = 0").collect()}
    assert empty and all(one[v] == two[v] for v in empty)


def test_a_record_without_a_slot_is_an_error(spark, table_of):
    records = numbered_copies(table_of([(i, "x") for i in range(50)]).select("doc_id")).withColumn("size", F.lit(1).cast("long"))
    records = records.withColumn("vslot", (F.col("doc_id") % 20).cast("int"))
    slot_map = edit_slot_map(slot_weights(records, 20), 4)
    assert place_records(records, slot_map).count() == 50
    with pytest.raises(Exception, match="Not in the slot map"):
        place_records(records, slot_map.where("vslot <> 3")).collect()
    with pytest.raises(Exception, match="Not in the slot map"):
        place_records(records.union(records), slot_map).collect()


def plain_deal(weights, shards, before=None):
    """Slots kept while they fit, the rest to the emptiest shard, one after the other."""
    share, loads, out = sum(weights.values()) / shards, [0] * shards, {}
    for shard in range(shards):
        held = 0
        for v in sorted((v for v in weights if before and before[v] == shard), key=lambda v: (-weights[v], v)):
            held += weights[v]
            if held <= share or not weights[v]:
                out[v] = shard
                loads[shard] += weights[v]
    for v in sorted((v for v in weights if v not in out), key=lambda v: (-weights[v], v)):
        to = loads.index(min(loads))
        out[v] = to
        loads[to] += max(weights[v], 1)
    return out


def test_maps_equal_a_plain_dealing(spark):
    rng = random.Random(4)
    weights = {v: rng.choice([0, 0, 10, 55, 900]) for v in range(300)}
    df = spark.createDataFrame([(v, b, 1) for v, b in weights.items()], "vslot int, bytes long, records long")
    first = edit_slot_map(df, 7).cache()
    one = {r["vslot"]: r["shard"] for r in first.collect()}
    assert one == plain_deal(weights, 7)
    weights = {v: rng.choice([0, 20, 300]) for v in weights}
    df = spark.createDataFrame([(v, b, 1) for v, b in weights.items()], "vslot int, bytes long, records long")
    for shards in (8, 5):
        assert {r["vslot"]: r["shard"] for r in edit_slot_map(df, shards, first).collect()} == plain_deal(weights, shards, one)
