"""Properties and negative cases of the core operators."""

import math

import pytest
from pyspark.sql import functions as F

from tessera.operators import curation, distillation, generation, partition, rollouts, selection
from tessera.sources import config, records
from tessera.streaming import resume


@pytest.mark.parametrize(("total", "n", "want"), [(10, 3, [4, 3, 3]), (7, 7, [1] * 7), (2, 3, [1, 1, 0]), (1000, 7, [143] * 6 + [142]), (0, 2, [0, 0])])
def test_split_counts(spark, total, n, want):
    assert partition.split_counts(total, n) == want
    rows = spark.range(total).repartition(3).withColumnRenamed("id", "k")
    got = {r.split: r.rows for r in partition.split_summary(partition.with_splits(rows, n, "k"), n).collect()}
    assert [got[i] for i in range(n)] == want


def test_global_index_replaces(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (None, "n"), (2, "b")], "k int, index string")
    got = partition.global_index(df, "k").orderBy("index").collect()
    assert [(r.k, r["index"]) for r in got] == [(None, 0), (1, 1), (2, 2), (3, 3)]


def test_best_of_n(spark):
    rows = [("t", 0, -0.5), ("t", 2, -0.5), ("t", 1, -0.9), ("s", 4, None), ("m", None, -0.1), ("m", 7, -0.1), ("f", 0, -0.2), ("f", 1, None), ("n", 0, math.nan), ("n", 1, -1.0)]
    df = spark.createDataFrame([(k, r, m, m, 2) for k, r, m in rows], "id string, rollout_id int, mean double, sum double, count long")
    got = {r.id: (r.selected_rollout_id, r.answer_logprob_mean, r.answer_token_count, r.selection_reason) for r in selection.best_of_n(df, "id").collect()}
    assert got == {"t": (0, -0.5, 2, selection.BEST), "s": (4, None, 0, selection.SINGLE), "m": (7, -0.1, 2, selection.BEST), "f": (None, None, None, None), "n": (None, None, None, None)}


def test_validity(spark):
    r = lambda i, e: (i, "r", "a", True, "stop", 1, e)
    df = spark.createDataFrame([("one", [r(0, None), r(1, "x"), r(2, ""), r(3, None)]), ("all", [r(i, "x") for i in range(4)]), ("null", None)], f"id string, rollouts array<{rollouts.ROLLOUT}>")
    any_ = {x.id: (x.rollout_valid, x.num_failed_rollouts) for x in rollouts.validity_unless_all_failed(df).collect()}
    assert any_ == {"one": (True, 1), "all": (False, 4), "null": (False, -1)} or any_["null"][0] is False
    none = {x.id: (x.rollout_valid, x.error, x.failed_rollout_id) for x in rollouts.validity_if_none_failed(df).collect()}
    assert none["one"] == (False, "x", 1) and none["all"][0] is False


@pytest.mark.parametrize(("expected", "got"), [([1, 2], [1]), ([1], [1, 2]), ([1, 1], [1]), ([1], [1, 1])])
def test_incomplete_raises(spark, expected, got):
    df = lambda x: spark.createDataFrame([(i,) for i in x], "id int")
    with pytest.raises(ValueError, match="incomplete"):
        selection.require_complete(df(expected), df(got))
    selection.require_complete(df([1, 2]), df([2, 1]))


def test_missing_record_raises(spark):
    s = spark.createDataFrame([(1,), (2,)], "id int")
    with pytest.raises(Exception, match="no record for 2"):
        selection.joined_strictly(s, spark.createDataFrame([(1, "a")], "id int, v string"), ["id"]).collect()


def test_last_write(spark):
    df = spark.createDataFrame([("a", 1, 0), ("a", 1, 1), ("b", 0, 5)], "id string, file int, line int")
    assert {(r.id, r.line) for r in selection.last_write(df, ["id"], ["file", "line"]).collect()} == {("a", 1), ("b", 5)}


def test_routing(spark):
    df = spark.createDataFrame([("analytical",), ("other",)], "key string")
    assert {r.teacher for r in distillation.routed(df, {"x": "only"}, "key").collect()} == {"only"}
    with pytest.raises(Exception, match="routing key other"):
        distillation.routed(df, {"analytical": "a", "real_world": "r"}, "key").collect()
    with pytest.raises(ValueError):
        distillation.routed(df, {}, "key")


def test_losses(spark):
    df = spark.createDataFrame([(0, math.log(0.25), math.log(0.5)), (1, math.log(0.75), math.log(0.5))], "token int, s double, t double")
    loss = lambda n: df.agg(F.sum(distillation.loss_of(n)(F.col("s"), F.col("t"))).alias("l")).first().l
    assert loss("forward_kl_topk") == pytest.approx(0.143841, abs=1e-6)
    assert loss("reverse_kl_topk_corrected") == pytest.approx(0.130812, abs=1e-6)
    with pytest.raises(ValueError, match="already"):
        distillation.register("kl")(lambda s, t: s)
    with pytest.raises(ValueError, match="unknown"):
        distillation.loss_of("none")


def test_hamming_copies_are_one_class(spark):
    df = spark.createDataFrame([(i, 0b1011) for i in range(50)] + [(60, 0b1000), (61, -1), (62, None)], "k long, h long")
    assert [tuple(r) for r in curation.hamming_pairs(df, "k", "h", 2).collect()] == [(0, 60, 2)]


def test_generation_failures_are_rows(spark):
    class Broken(generation.EchoClient):
        def complete(self, prompt, image=None, sampling=None):
            raise RuntimeError("down")

    prompts = spark.createDataFrame([("a", "x"), ("b", "yy")], "id string, prompt string")
    rows = generation.generate(prompts, Broken(), 2, retries=2, wait=0).collect()
    assert len(rows) == 4 and all(r.response is None and r.finish_reason is None and "down" in r.error for r in rows)
    good = generation.gathered(generation.generate(prompts, generation.EchoClient(), 3)).collect()
    assert all([x.rollout_id for x in r.rollouts] == [0, 1, 2] and r.rollouts[0].finish_reason == "stop" for r in good)


def shaky():
    """A client of a class that travels to workers by value."""

    class Shaky(generation.EchoClient):
        """Fails the first time that it is asked for a prompt, and counts calls under way."""

        def __init__(self):
            self.asked, self.now, self.most = {}, 0, 0

        def _once(self, what):
            import time

            self.now += 1
            self.most = max(self.most, self.now)
            time.sleep(0.002)
            self.now -= 1
            self.asked[what] = self.asked.get(what, 0) + 1
            if self.asked[what] == 1 and "x" in what:
                raise RuntimeError("once")

        def complete(self, prompt, image=None, sampling=None):
            self._once(prompt)
            return f"{prompt} {image} {sampling['top_p']} asked {self.asked[prompt]} most {self.most}", "length"

        def logprobs(self, prompt, image, response):
            self._once(prompt + response)
            return super().logprobs(prompt, image, response)

    return Shaky()


def test_generation_retries_each_prompt(spark):
    """A prompt that fails once succeeds; those beside it are asked once; calls overlap, within their bound; order and fields are kept."""
    prompts = spark.createDataFrame([(str(i), ("x" if i % 3 == 0 else "y") + str(i), f"data:{i}") for i in range(40)], "id string, prompt string, image string").coalesce(1)
    rows = {r.id: r for r in generation.generate(prompts, shaky(), 1, retries=2, wait=0, in_flight=4, sampling={"top_p": 0.9}, thinking=True).collect()}
    assert len(rows) == 40 and all(r.error is None and r.finish_reason == "length" for r in rows.values())
    assert all(r.response.startswith(f"<think>{'x' if i % 3 == 0 else 'y'}{i} data:{i} 0.9 asked {2 if i % 3 == 0 else 1} ") for i, r in ((int(k), r) for k, r in rows.items()))
    assert 1 < max(int(r.response.split()[-1]) for r in rows.values()) <= 4
    failed = generation.generate(prompts, shaky(), 1, retries=1, wait=0, in_flight=4, sampling={"top_p": 0.9}).where("error is not null")
    assert failed.count() == 14


def test_scoring_retries(spark):
    rows = spark.createDataFrame([("a", 0, "x ", "t <answer>abc</answer>")], "id string, rollout_id int, prompt string, response string")
    got = [generation.score_candidates(rows, shaky(), retries=n, wait=0).first() for n in (1, 3)]
    assert got[0].score_error == "RuntimeError: once" and got[1].score_error is None and got[1]["count"] == 3


def test_rows_in_flight_are_bounded():
    drawn = []
    out = generation.in_order((drawn.append(i) or i for i in range(1000)), lambda i: i * i, 4)
    assert [next(out) for _ in range(3)] == [(0, 0), (1, 1), (2, 4)] and len(drawn) <= 11
    assert [x for x, _ in out] == list(range(3, 1000))


def test_chat_client(spark):
    """Against a server on this machine: the message's parts, sampling parameters, errors with their status."""
    import json
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    class Server(BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            text, bad = body["messages"][0]["content"][0]["text"], False
            if "prompt_logprobs" in body:
                said = body["messages"][1]["content"]
                reply = {"prompt_token_ids": [ord(c) for c in said], "prompt_logprobs": [None, *({str(ord(c)): {"logprob": -0.5}} for c in said[1:])]}
            else:
                bad = text == "bad"
                reply = {"choices": [{"message": {"content": f"{body['model']} {len(body['messages'][0]['content'])} {body.get('top_k')}"}, "finish_reason": "stop"}]}
            data = b"no" if bad else json.dumps(reply).encode()
            self.send_response(500 if bad else 200)
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        client = generation.ChatClient(f"http://127.0.0.1:{server.server_port}", "m", 10)
        rows = spark.createDataFrame([("a", "hi", "data:x"), ("b", "bad", None)], "id string, prompt string, image string")
        got = {r.id: r for r in generation.generate(rows, client, 1, retries=1, sampling={"top_k": 5}).collect()}
        assert (got["a"].response, got["a"].finish_reason) == ("m 2 5", "stop") and got["b"].error == "RuntimeError: HTTP 500: no"
        scored = generation.score_candidates(spark.createDataFrame([("a", 0, "q", "t <answer>abc</answer>")], "id string, rollout_id int, prompt string, response string"), client).first()
        assert scored["count"] == 3 and scored.sum == -1.5
    finally:
        server.shutdown()


def test_resume_after_a_failed_write(spark, tmp_path):
    """The batch's first write is done, its second fails: the next run makes the batch again, and no row is lost."""
    d = {k: str(tmp_path / k) for k in ("in", "out", "failed", "check")}
    work = lambda b: b.withColumn("valid", F.col("id") < 8)
    spark.range(10).coalesce(1).write.parquet(d["in"])
    (tmp_path / "failed").write_text("in the way of the second write")
    with pytest.raises(Exception):  # noqa: B017  the stream's own exception
        resume.run(spark, d["in"], "id long", d["out"], d["failed"], d["check"], work)
    assert resume.stored(spark, d["out"]).count() == 8
    (tmp_path / "failed").unlink()
    resume.run(spark, d["in"], "id long", d["out"], d["failed"], d["check"], work)
    assert resume.stored(spark, d["out"]).count() == 8 and spark.read.parquet(d["failed"]).count() == 2


def test_resume_twice_is_once(spark, tmp_path):
    work = lambda b: b.withColumn("valid", F.col("id") != "bad")
    d = {k: str(tmp_path / k) for k in ("in", "out", "failed", "check")}
    for part in (["a", "bad"], ["a", "b", "bad"]):
        spark.createDataFrame([(x,) for x in part], "id string").write.mode("append").parquet(d["in"])
        resume.run(spark, d["in"], "id string", d["out"], d["failed"], d["check"], work)
    got = resume.stored(spark, d["out"])
    assert sorted(r.id for r in got.collect()) == ["a", "b"]
    assert spark.read.parquet(d["failed"]).count() == 2
    assert resume.finished(got, 2) and not resume.finished(got, 3) and not resume.finished(None, 0)


def test_resume_with_another_checkpoint(spark, tmp_path):
    """A lost checkpoint offers everything again: what is stored stays and is not done twice."""
    d = {k: str(tmp_path / k) for k in ("in", "out", "failed")}
    work = lambda b: b.withColumn("valid", F.lit(True))
    for k, rows in enumerate((range(5), range(5, 9))):
        spark.createDataFrame([(i,) for i in rows], "id long").coalesce(1).write.mode("append").parquet(d["in"])
        resume.run(spark, d["in"], "id long", d["out"], d["failed"], str(tmp_path / f"check{k}"), work)
    got = resume.stored(spark, d["out"])
    assert sorted(r.id for r in got.collect()) == list(range(9)) and len({r.batch for r in got.select("batch").collect()}) == 2


def test_cluster_needs_a_shared_folder(monkeypatch):
    from types import SimpleNamespace

    from tessera.session import shared_dir

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None, getConf=lambda: {})
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(SimpleNamespace(sparkContext=context, conf={}))


def test_sources(spark, tmp_path):
    p = str(tmp_path / "log.jsonl")
    with open(p, "w") as f:
        f.write('{"id": "a", "n": 1}\n\n{"id": \n{"id": "b"}\n')
    rows, bad = records.jsonl(spark, p, "id string, n long")
    assert sorted((r.id, r.n) for r in rows.collect()) == [("a", 1), ("b", None)] and [r.line for r in bad.collect()] == ['{"id": ']
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        records.jsonl(spark, p, "id string, n long", strict=True)[0].collect()
    records.write_both(rows.withColumn("ok", F.col("n").isNotNull()), "ok", str(tmp_path / "good"), str(tmp_path / "bad"))
    assert spark.read.json(str(tmp_path / "good")).count() == spark.read.json(str(tmp_path / "bad")).count() == 1
    for i in range(3):
        spark.range(i + 1).coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "tmp"))
        (tmp_path / "splits").mkdir(exist_ok=True)
        next((tmp_path / "tmp").glob("part-*.parquet")).rename(tmp_path / "splits" / f"{i}.parquet")
    assert {r.split: r["count"] for r in records.adopted_splits(spark, str(tmp_path / "splits"), 3).groupBy("split").count().collect()} == {0: 1, 1: 2, 2: 3}
    with pytest.raises(ValueError):
        records.adopted_splits(spark, str(tmp_path / "splits"), 4)


def test_config(tmp_path):
    assert config.flatten({"a": {"b": True, "c": [1]}, "d": 1}) == {"A_B": "true", "D": "1"}
    with pytest.raises(ValueError):
        config.prompt(str(tmp_path / "x.placeholder"))
    assert config.resolve("x.txt", str(tmp_path / "c.yaml")) == str(tmp_path / "x.txt")


def test_projection_is_pruned_and_filter_pushed(spark, tmp_path):
    p = str(tmp_path / "t")
    spark.range(10).withColumn("text", F.lit("x")).write.parquet(p)
    plan = spark.read.parquet(p).where("id > 5").select("id")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<id:bigint>" in plan and "GreaterThan(id,5)" in plan


IMAGE = "image struct<origin: string, height: int, width: int, nChannels: int, mode: int, data: binary>"


def test_images(spark):
    from tessera.functions import vision

    flat, steps = bytes([90] * 20 * 20 * 3), bytes((i % 20) * 12 for i in range(20 * 20) for _ in range(3))
    rows = [((n, h, w, 3, 16, d),) for n, h, w, d in (("flat", 20, 20, flat), ("steps", 20, 20, steps), ("bad", -1, -1, b""), ("short", 20, 20, b"12"))]
    df = spark.createDataFrame(rows, IMAGE)
    got = {r.image.origin: r for r in vision.sharpness(df).collect()}
    assert got["flat"].spread == got["flat"].edges == 0 and got["steps"].spread > 100 and got["bad"].spread is None and got["short"].edges is None
    hashes = {r.image.origin: r.dhash for r in vision.difference_hash(df).collect()}
    assert hashes == {"flat": 0, "steps": 0, "bad": None, "short": None}
    turned = spark.createDataFrame([(("turned", 20, 20, 3, 16, bytes(reversed(steps))),)], IMAGE)
    assert vision.difference_hash(turned).first().dhash == -1


def exif(turn, order="<"):
    import struct

    entry = struct.pack(f"{order}HHIHH", 0x0112, 3, 1, turn, 0)
    return b"\xff\xd8\xff\xe1\x00\x22Exif\0\0" + (b"II" if order == "<" else b"MM") + struct.pack(f"{order}HI", 42, 8) + struct.pack(f"{order}H", 1) + entry


def test_orientation():
    """The eight orientations: where the first row and column of the stored pixels belong in the upright image."""
    import numpy as np

    from tessera.functions import vision

    x = np.arange(6).reshape(2, 3, 1)
    want = {1: [[0, 1, 2], [3, 4, 5]], 2: [[2, 1, 0], [5, 4, 3]], 3: [[5, 4, 3], [2, 1, 0]], 4: [[3, 4, 5], [0, 1, 2]], 5: [[0, 3], [1, 4], [2, 5]], 6: [[3, 0], [4, 1], [5, 2]], 7: [[5, 2], [4, 1], [3, 0]], 8: [[2, 5], [1, 4], [0, 3]]}
    assert {t: vision.upright(x, t)[..., 0].tolist() for t in want} == want
    assert [vision.exif_turn(exif(t, o)) for t in want for o in "<>"] == [t for t in want for _ in "<>"]
    assert [vision.exif_turn(b) for b in (None, b"", b"Exif\0\0", b"Exif\0\0II", exif(6)[:20], exif(9))] == [1] * 6


def test_model_url(spark, tmp_path):
    """Decoded again: turned, in RGB, small sides grown and large ones shrunk; flat stays flat."""
    import base64
    import struct
    import zlib

    import numpy as np

    from tessera.functions import vision

    def read(url):
        body = base64.b64decode(url.removeprefix("data:image/png;base64,"))
        w, h = struct.unpack(">II", body[16:24])
        (n,) = struct.unpack(">I", body[33:37])
        return np.frombuffer(zlib.decompress(body[41 : 41 + n]), np.uint8).reshape(h, 1 + 3 * w)[:, 1:].reshape(h, w, 3)

    x = np.random.default_rng(1).integers(0, 256, (40, 50, 3), dtype=np.uint8)
    rows = [(("plain", 40, 50, 3, 16, x.tobytes()), None), (("turned", 40, 50, 3, 16, x.tobytes()), 6), (("grey", 20, 40, 1, 0, bytes([7]) * 800), 1), (("wide", 40, 4096, 4, 24, bytes([1, 2, 3, 255]) * 40 * 4096), 1), (("bad", -1, -1, -1, -1, b""), 1)]
    got = {r.image.origin: r.url for r in vision.model_url(spark.createDataFrame(rows, f"{IMAGE}, orientation int")).collect()}
    assert got.pop("bad") is None
    got = {k: read(u) for k, u in got.items()}
    assert (got["plain"] == x[..., ::-1]).all() and (got["turned"] == x[..., ::-1].transpose(1, 0, 2)[:, ::-1]).all()
    assert got["grey"].shape == (32, 64, 3) and (got["grey"] == 7).all() and got["wide"].shape == (20, 2048, 3) and (got["wide"] == [3, 2, 1]).all()
    (tmp_path / "a.jpg").write_bytes(exif(8))
    assert vision.orientations(spark.read.format("binaryFile").load(str(tmp_path))).first().orientation == 8
    ramp = np.tile(np.arange(64.0)[:, None, None], (1, 2, 1))
    assert np.abs(vision.resized(ramp, 32)[4:-4, 0, 0] - (np.arange(32) * 2 + 0.5)[4:-4]).max() < 1e-6


@pytest.mark.parametrize("tile", [2000, 7])
def test_cosine_pairs(spark, tile, monkeypatch):
    """Against all pairs: hot blocks in tiles, copies paired with the least of them alone, null vectors and those of length 0."""
    import numpy as np

    monkeypatch.setattr(curation, "TILE", tile)
    rng = np.random.default_rng(3)
    v = rng.normal(size=(60, 5))
    rows = [(i, i % 2, v[i].tolist()) for i in range(60)] + [(100 + i, 1, [1.0, 2.0, 0.0, 0.0, 0.5]) for i in range(20)] + [(200, 1, None), (201, 1, [0.0] * 5), (202, 0, [2.0, 4.0, 0.0, 0.0, 1.0])]
    got = {(r.a, r.b): r.cosine for r in curation.cosine_pairs(spark.createDataFrame(rows, "id int, block int, v array<double>"), "id", "v", 0.4).collect()}
    cos = lambda x, y: float(np.dot(x, y) / np.linalg.norm(x) / np.linalg.norm(y))
    some = [r for r in rows if r[2] and any(r[2]) and not 100 < r[0] < 200]
    want = {(a[0], b[0]): c for i, a in enumerate(some) for b in some[i + 1 :] if a[1] == b[1] and (c := cos(a[2], b[2])) >= 0.4}
    want |= {(100, i): 1.0 for i in range(101, 120)}
    assert {(min(k), max(k)): pytest.approx(c) for k, c in want.items()} == got
    free = curation.cosine_pairs(spark.createDataFrame([(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0])], "id int, v array<double>"), "id", "v", 0.99)
    assert [(r.a, r.b) for r in free.collect()] == [(1, 2)]


def test_hamming_pairs_in_tiles(spark, monkeypatch):
    import random

    monkeypatch.setattr(curation, "TILE", 9)
    r = random.Random(1)
    base = [r.getrandbits(64) for _ in range(6)]
    rows = [(i, x - (1 << 64) if (x := base[i % 6] ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64))) >> 63 else x) for i in range(120)]
    least = {}
    for k, x in rows:
        least[x] = min(least.get(x, k), k)
    own = sorted((k, x) for x, k in least.items())
    want = {(a, b, bin((x ^ y) & (2**64 - 1)).count("1")) for i, (a, x) in enumerate(own) for b, y in own[i + 1 :]}
    got = {tuple(p) for p in curation.hamming_pairs(spark.createDataFrame(rows, "k long, h long"), "k", "h", 3).collect()}
    assert got == {p for p in want if p[2] <= 3}


def test_plans_at_scale(spark, tmp_path):
    """One exchange for log-softmax and top tokens; global_index joins its offsets by broadcast and has no window over rows."""
    logits = spark.range(100).selectExpr("id % 10 AS pos", "id AS token_id", "cast(id AS double) AS logit")
    plan = selection.top_tokens(distillation.log_softmax(logits, ["pos"]), ["pos"], 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    plan = partition.global_index(spark.range(100).withColumnRenamed("id", "k"), "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "RDD" not in plan


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "é", "a"), (2, "b", "b")], "id int, text string, part string")
    for _ in range(2):
        records.append_jsonl(df, str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 4 and "é" in "".join(p.read_text() for p in (tmp_path / "log").glob("part-*"))
    records.write_parquet(df, str(tmp_path / "t"), "part")
    records.write_parquet(df.where("part = 'a'").withColumn("text", F.lit("new")), str(tmp_path / "t"), "part")
    assert {(r.id, r.text) for r in records.parquet(spark, str(tmp_path / "t"), "id", "text").collect()} == {(1, "new"), (2, "b")}
    assert records.row_count(spark, str(tmp_path / "t")) == 2


def test_exact_duplicates_with_nulls(spark):
    df = spark.createDataFrame([(3, None, "x"), (1, None, "x"), (2, "", "x")], "id int, a string, b string")
    assert {(r.id, r.keeper) for r in curation.exact_duplicates(df, "id", "a", "b").collect()} == {(3, 1), (1, 1), (2, 2)}


def test_metadata_and_keys(spark):
    df = spark.createDataFrame([(5, None, "q")], "index long, id string, question string")
    assert df.select(*rollouts.metadata(df)).first().asDict() == {"index": 5, "id": "5", "question": "q"}
    assert df.select(rollouts.key(df).alias("k")).first().k == "5"


def test_score_candidates(spark):
    class Down(generation.EchoClient):
        def logprobs(self, prompt, image, response):
            raise RuntimeError("down")

    rows = spark.createDataFrame([("a", 0, "Q ", "x <answer>abc</answer>"), ("a", 1, "Q ", "no answer"), ("b", 0, "Q ", None)], "id string, rollout_id int, prompt string, response string")
    got = {(r.id, r.rollout_id): r for r in generation.score_candidates(rows, generation.EchoClient()).collect()}
    want = [-(ord(c) % 7) / 10 for c in "abc"]
    assert got["a", 0]["count"] == 3 and got["a", 0].sum == pytest.approx(sum(want)) and got["a", 0].score_error is None
    assert got["a", 1].score_error == got["b", 0].score_error == "no answer at the end"
    assert {r.score_error for r in generation.score_candidates(rows, Down(), wait=0).collect()} == {"RuntimeError: down", "no answer at the end"}
