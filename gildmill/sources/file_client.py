"""A document client for the batch sink that keeps a collection as files in a shared folder.

Each load has a folder of its own with one JSON file per batch; the file ``current`` names
the load that is the collection. A batch's file is named by task, attempt, number and documents:
``publish`` removes what attempts other than the committed ones have left, and ``count`` adds up
the files that are there, without opening them.
"""

from __future__ import annotations

import json

from pyarrow import fs


class FileClient:
    def __init__(self, options: dict):
        self.files, self.root = fs.FileSystem.from_uri(options["folder"])
        self.load = options.get("load")
        self.attempt = f"{options.get('task', '0')}-{options.get('attempt', '0')}"
        self.sent = 0

    def _write(self, path: str, text: str) -> None:
        with self.files.open_output_stream(f"{self.root}/{path}") as out:
            out.write(text.encode("utf-8"))

    def _read(self, path: str) -> str:
        with self.files.open_input_stream(f"{self.root}/{path}") as source:
            return source.read().decode("utf-8")

    def prepare(self) -> None:
        self.files.create_dir(f"{self.root}/{self.load}", recursive=True)

    def send(self, batch: list[dict]) -> None:
        self._write(f"{self.load}/{self.attempt}-{self.sent}-{len(batch)}.json", json.dumps(batch))
        self.sent += 1

    def publish(self, documents: int, committed: list[str]) -> None:
        known = set(committed)
        for name in self._batches(self.load):
            if name.rsplit("-", 2)[0] not in known:
                self.files.delete_file(f"{self.root}/{self.load}/{name}")
        self._write("current", json.dumps({"load": self.load, "documents": documents}))

    def _batches(self, load: str) -> list[str]:
        found = self.files.get_file_info(fs.FileSelector(f"{self.root}/{load}"))
        return [f.base_name for f in found if f.base_name.endswith(".json")]

    def discard(self) -> None:
        self.files.delete_dir(f"{self.root}/{self.load}")

    def count(self) -> int:
        load = json.loads(self._read("current"))["load"]
        return sum(int(name.removesuffix(".json").rsplit("-", 1)[1]) for name in self._batches(load))

    def collection(self) -> str:
        """The folder of the published load."""
        return f"{self.root}/{json.loads(self._read('current'))['load']}"

    def close(self) -> None:
        pass


def connect(options: dict) -> FileClient:
    return FileClient(options)
