"""Random lines through three layouts, checked against a plain-Python parse
of the intended semantics (brute force on a small fixture)."""

import json
import random
import re
from datetime import datetime, timezone

from cdrflow.operators.asof import versions_per_operator
from cdrflow.operators.standardize import parse_lines
from cdrflow.schema import LINE_FIELDS, URL_PATTERN
from cdrflow.sources.descriptors import parse_descriptors

TYPES = {"session_time": "int", "page_sent": "int", "duration": "int"}
BASE = [(name, TYPES.get(name, "String"), "") for name in LINE_FIELDS]
V2 = [BASE[1], BASE[0], BASE[2], ("cell", "String", ""), BASE[3], BASE[4],
      ("session_time", "String", "yyyy-MM-dd HH:mm:ss")] + BASE[6:]
V3 = BASE[:5] + [("session_time", "long", "")] + BASE[6:9] + [("duration", "long", "")] + BASE[10:]
VERSIONS = {  # name: (start, start epoch, delimiter, fields)
    "v1": ("2020-01-01 00:00:00", 1577836800, ";", BASE),
    "v2": ("2020-06-01 00:00:00", 1590969600, "|", V2),
    "v3": ("2021-01-01 00:00:00", 1609459200, "^", V3),
}


def descriptor(start, delim, fields):
    body = {"fields": [{"name": n, "type": t, "format": f} for n, t, f in fields]}
    return f"format_start_date_time={start}\ndelimiter={delim}\nfields={json.dumps(body)}\n"


def rand_text(rng, n=6):
    return "".join(rng.choice("abcXYZ019-_:/ .+") for _ in range(rng.randint(0, n)))


def make_line(rng, i):
    version = rng.choice(["v1", "v2", "v3"])
    _, start, delim, fields = VERSIONS[version]
    t = rng.randint(start - 86400 * 200, start + 86400 * 150)
    urls = [rng.choice([f"http://h{rng.randint(0, 9)}.example/p{rng.randint(0, 99)}",
                        f"file:/x/{rng.randint(0, 9)}.xml#a{rng.randint(0, 3)}"])
            + rng.choice(["", "?q=1"]) for _ in range(rng.randint(0, 4))]
    values = {
        "msisdn": "+33" + str(rng.randint(10**8, 10**9)), "imsi": rng.choice(["", str(rng.randint(10**14, 10**15))]),
        "imei": rand_text(rng), "subscription": rand_text(rng), "language": rng.choice(["en", "", "fr"]),
        "session_time": (datetime.fromtimestamp(t, timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
                         if version == "v2" else str(t)),
        "service_code": rng.choice(["#701", "#702", ""]), "bearer": rng.choice(["U2", "sms"]),
        "page_sent": rng.choice([str(len(urls)), "x", "", "-2", "+4", "99999999999", " 5"]),
        "duration": rng.choice([str(rng.randint(0, 999)), "1.5", "", "4000000000"]),
        "vlr_number": rand_text(rng), "session_end": "", "cell": str(rng.randint(0, 99)),
        "action_url": ("#1*#=" + ",".join(f"{k}={u}" for k, u in enumerate(urls))) if urls else "",
        "extra": rand_text(rng),
    }
    parts = [values[n] for n, _, _ in fields]
    if rng.random() < 0.2:
        parts = parts[:-1]  # trailing field left out
    return delim.join(parts)


def java_int(text, bits):
    if text is None or not re.fullmatch(r"[+-]?[0-9]+", text):
        return None
    v = int(text)
    return v if -(2 ** (bits - 1)) <= v < 2 ** (bits - 1) else None


def brute(line):
    """Expected parse: newest version whose own reading of the time is >= its start."""
    for name in ("v3", "v2", "v1"):
        start_text, start, delim, fields = VERSIONS[name]
        parts = line.split(delim)
        pos = {n: i for i, (n, _, _) in enumerate(fields)}
        types = {n: t.upper() for n, t, _ in fields}

        def raw(n):
            return parts[pos[n]] if n in pos and pos[n] < len(parts) else None
        r = raw("session_time")
        if types["session_time"] in ("INT", "LONG"):
            t = java_int(r, 64)
        else:
            try:
                t = int(datetime.strptime(r, "%Y-%m-%d %H:%M:%S").replace(tzinfo=timezone.utc).timestamp())
            except (TypeError, ValueError):
                t = None
        if t is None or t < start:
            continue
        out = {}
        for n in LINE_FIELDS:
            v, kind = raw(n), types.get(n)
            if n == "session_time":
                out[n] = t
            elif n in ("page_sent", "duration"):
                x = java_int(v, 64 if kind == "LONG" else 32)
                out[n] = str(x) if x is not None else None
            elif n == "action_url":
                out["urls"] = re.findall(URL_PATTERN, v) if v is not None else []
            else:
                out[n] = v
        out["format"] = name
        return out
    return None


def test_random_lines_match_brute_force(spark):
    rng = random.Random(20240101)
    lines = [make_line(rng, i) for i in range(600)]
    desc = spark.createDataFrame(
        [("d", "t", f"data_format-x-op-{n}.properties", descriptor(s, d, f), 1)
         for n, (s, _, d, f) in VERSIONS.items()],
        "dc string, datatype string, file_name string, content string, registered_at bigint")
    cat = versions_per_operator(parse_descriptors(desc))
    df = spark.createDataFrame(
        [("d", "t", 1, "op", "f", i, l) for i, l in enumerate(lines)],
        "dc string, datatype string, batch_id bigint, op string, source_file string, row_id bigint, line string")
    got = {r["row_id"]: r for r in parse_lines(df, cat).collect()}
    rejected = 0
    for i, line in enumerate(lines):
        want, row = brute(line), got[i]
        if want is None:
            rejected += 1
            assert row["reason"] == "no_valid_format", line
            continue
        assert row["format_name"] == f"data_format-x-op-{want['format']}.properties", line
        for n in LINE_FIELDS:
            key = "urls" if n == "action_url" else n
            assert row[key] == want[key], (line, n, row[key], want[key])
    assert 0 < rejected < len(lines)
