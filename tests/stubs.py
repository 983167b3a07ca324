"""Stand-ins for outside services: a key-value server and a geocoder."""

import json
import os
import time
import uuid


class FileKVClient:
    """In-process stand-in for a KV server: each ``set_many`` call appends one
    JSON line (the pipelined chunk) to a file under ``root``. Used in tests
    and dry runs; ``read_all`` replays the files into a dict."""

    def __init__(self, root: str):
        self.root = root
        os.makedirs(root, exist_ok=True)
        # creation-time prefix: replaying files in name order replays writes in order
        self.path = os.path.join(root, f"client-{time.time_ns():020d}-{uuid.uuid4().hex}.jsonl")

    def set_many(self, items: list[tuple[str, str]], ttl_s: int | None) -> None:
        with open(self.path, "a", encoding="utf-8") as f:
            f.write(json.dumps({"ttl": ttl_s, "items": items}) + "\n")

    def hset_many(self, name: str, items: list[tuple[str, str]]) -> None:
        self.set_many([(f"{name}/{k}", v) for k, v in items], None)

    def close(self) -> None:
        pass

    @staticmethod
    def read_all(root: str) -> tuple[dict[str, str], list[int]]:
        """(final key->value map, sizes of every pipelined chunk)."""
        kv, sizes = {}, []
        for name in sorted(os.listdir(root)):
            with open(os.path.join(root, name), encoding="utf-8") as f:
                for line in f:
                    rec = json.loads(line)
                    sizes.append(len(rec["items"]))
                    kv.update(dict(rec["items"]))
        return kv, sizes
