import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from placewise.session import build_session  # noqa: E402
from placewise.sources.posts import read_posts  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
                            spark__driver__memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def post(id, text="plain", author="1", created="2024-01-15T10:00:00.000Z", source="web", places=None, users=None):
    """One invented post as a dict; ``places`` and ``users`` are left out when None."""
    includes = {}
    if places is not None:
        includes["places"] = [{"full_name": p, "id": f"p-{p}"} for p in places]
    if users is not None:
        includes["users"] = [dict(id=author, name=n, username=n, **({"location": l} if l else {})) for n, l in users]
    data = {"id": id, "text": text, "author_id": author, "created_at": created, "source": source}
    return {"data": data, **({"includes": includes} if includes else {})}


# One post per trap; all invented.
TRAPS = [
    post("1", "good day @ann hi", "a", places=["Rivertown"], users=[("nell", "Rivertown")]),
    post("2", "plain", "a", users=[("nell", None)]),
    post("3", "plain", "b"),
    post("4", "plain", "b", places=[]),
    post("5", "happy", "c", created="xx", places=["Hillford"]),
    post("6", "two @ann lines\n@bob end", "c"),
    post("7", "@ann and @bob here", "c", source="phone", places=["Hillford"], users=[("omar", "Hillford")]),
    post("8", "ends in @ann", "d"),
    post("9", "FUN", "d"),
    post("10", "a funeral", "d"),
    post("11", "late", "d", created="2024-01-15T23:10:00.000Z", places=["Lakeside"], users=[("unknown", "Sea")]),
    post("12", "@ann\nnext line", "d"),
]


def write_lines(path, posts, torn=False):
    path.mkdir(parents=True, exist_ok=True)
    lines = [json.dumps(p, ensure_ascii=False) for p in posts]
    if torn:
        lines[1:1] = ["", '{"data":{"id":"99","text":"cut o']
    (path / "part-0.json").write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


@pytest.fixture(scope="session")
def traps_dir(tmp_path_factory):
    return write_lines(tmp_path_factory.mktemp("landing") / "traps", TRAPS, torn=True)


@pytest.fixture(scope="session")
def traps(spark, traps_dir):
    return read_posts(spark, traps_dir)


def as_dict(df, key, *values):
    rows = df.collect()
    assert len({r[key] for r in rows}) == len(rows)
    return {r[key]: tuple(r[v] for v in values) if len(values) > 1 else r[values[0]] for r in rows}
