"""A server for tests: what it answers stands in the URL, `<folder>|<status>|<body>`; each request leaves a file in the folder."""

import uuid
from pathlib import Path


def get(url):
    folder, status, body = url.split("|", 2)
    Path(folder, uuid.uuid4().hex).write_text(url)
    if status == "down":
        raise ConnectionError("no route")
    return int(status), body.encode(), 0.0


def made(folder):
    return sorted(p.read_text().split("|", 1)[1] for p in Path(folder).iterdir())
