"""A vector store client for tests: each request is a JSON file in a folder."""

from __future__ import annotations

import json
import os
import shutil
import uuid


class FileStore:
    def __init__(self, folder: str) -> None:
        self.folder = folder

    def recreate_collection(self, name, config):
        path = os.path.join(self.folder, name)
        os.makedirs(path, exist_ok=True)
        with open(os.path.join(path, "config"), "w") as out:
            json.dump(config, out)

    def replace_collection(self, name, by):
        path = os.path.join(self.folder, name)
        shutil.rmtree(path, ignore_errors=True)
        os.rename(os.path.join(self.folder, by), path)

    def drop_collection(self, name):
        shutil.rmtree(os.path.join(self.folder, name), ignore_errors=True)

    def upsert(self, name, points):
        path = os.path.join(self.folder, name)
        os.makedirs(path, exist_ok=True)
        with open(os.path.join(path, uuid.uuid4().hex + ".json"), "w") as out:
            json.dump(points, out)
        if any("fails" in str(point[0]) for point in points):
            raise ConnectionError("request refused")


def connect(options):
    if options.get("broken"):
        raise ConnectionError("store is down")
    return FileStore(options["url"])
