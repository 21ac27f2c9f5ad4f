"""Landing and sanitised loads against a plain row-by-row interpreter, on dirty input."""

import datetime as dt
import json
import random
import re

import pytest

from strata.plans.config import QUARANTINE_TABLE, Run, standard_entities
from strata.plans.load import load_landing, load_sanitised, set_up
from strata.sinks.store import Store

DAYS = [dt.date(2026, 5, d) for d in (1, 2, 3)]


def dirty(rng):
    """A release record, or something that is not one."""
    if rng.random() < 0.08:
        return rng.choice([5, "s", None, [1], True])
    record = {
        "id": rng.choice(["r1", "r2", "r3", "r4", "", None, 0, False]),
        "artist_id": rng.choice(["a1", "r2", "", None]),
        "title": rng.choice(["1989", "None", "NULL", " none ", "Zoë's \"x\"", "", None, 7, [1, "a"], {"k": "v"}]),
        "date": rng.choice(["1989", "2020-05", "2020-13", "2020-01-31", "1989\n", "abc", "null", 1989, None]),
        "country": rng.choice(["IN", "none", None, "GB"]),
        "status": rng.choice(["Official", "nUlL", None]),
        "created_at": rng.choice([None, "", "None", "2019-01-02 03:04:05", "soon"]),
        "unknown": 1,
    }
    return {k: v for k, v in record.items() if v is not None or rng.random() < 0.5}


def as_text(v):
    if v is None or isinstance(v, str):
        return v
    return json.dumps(v, separators=(",", ":"), ensure_ascii=False)


def cleaned(v):
    text = as_text(v)
    return None if text is not None and text.lower() in ("none", "null") else text


def completed(v):
    text = cleaned(v)
    if isinstance(v, str) and text is not None:
        if re.fullmatch(r"[0-9]{4}", text):
            return text + "-01-01"
        if re.fullmatch(r"[0-9]{4}-[0-9]{2}", text):
            return text + "-01"
    return text


def as_day(text):
    try:
        return dt.date.fromisoformat(text) if text and re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", text) else None
    except ValueError:
        return None


class Model:
    def __init__(self):
        self.landing, self.sanitised, self.rejected = {}, {}, 0

    def load(self, records, now):
        touched = []
        for r in records:
            key = (r.get("id") or r.get("artist_id")) if isinstance(r, dict) else None
            given = r.get("created_at") if isinstance(r, dict) else None
            absent = given is None or given == "" or given.lower() in ("none", "null")
            if not key or given == "soon":
                self.rejected += 1
                continue
            created = now if absent else dt.datetime.fromisoformat(given)
            held = self.landing.get(key)
            self.landing[key] = (r, held[1] if held else created, now)
            touched.append(key)
        for key in dict.fromkeys(touched):
            r = self.landing[key][0]
            day_text = completed(r.get("date"))
            new = {
                "artist_id": cleaned(r.get("artist_id")), "group_id": None, "title": cleaned(r.get("title")),
                "release_date": as_day(day_text), "date_raw": day_text, "country": cleaned(r.get("country")),
                "status": cleaned(r.get("status")), "ingestion_date": now,
                "etl_batch_id": f"{now:%Y%m%d}000000_src",
            }
            row = self.sanitised.setdefault(key, dict.fromkeys(new))
            row.update({k: v for k, v in new.items() if v is not None})


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_loads_equal_row_by_row(spark, tmp_path, seed):
    rng, model = random.Random(seed), Model()
    entity = standard_entities(buckets=rng.choice([1, 4]), layout=rng.choice(["array", "indented"]))["releases"]
    store = Store(spark, str(tmp_path / "store"))
    set_up(store, {"releases": entity})
    folder = tmp_path / "raw" / "releases"
    folder.mkdir(parents=True)
    for day in DAYS:
        records = [dirty(rng) for _ in range(rng.choice([1, 12, 40]))]
        text = json.dumps(records, indent=4, ensure_ascii=False)
        (folder / f"releases_{day:%Y_%m_%d}.json").write_text(text, encoding="utf-8")
        run = Run(f"{day:%Y%m%d}000000_src", f"{day} 00:00:00", str(tmp_path / "raw"))
        loaded = load_landing(store, entity, run)
        assert loaded.rows_read == len(records) == loaded.rows_good + loaded.rows_rejected
        load_sanitised(store, entity, run)
        model.load(records, dt.datetime.combine(day, dt.time()))

    landed = {r.id: (json.loads(r.payload), r.created_at, r.updated_at) for r in store.read(entity.landing).collect()}
    assert landed == model.landing
    got = {r.release_id: {k: v for k, v in r.asDict().items() if k != "release_id"} for r in store.read(entity.sanitised).collect()}
    assert got == model.sanitised
    assert store.read(QUARANTINE_TABLE).count() == model.rejected
