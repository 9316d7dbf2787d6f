"""Files of the shared folder that tasks read and write by themselves."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder that is given as a path or as a uri."""
    if "://" not in folder and folder.startswith("file:"):
        folder = folder[len("file:"):]
    if "://" in folder:
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), folder


def names(folder: str, ending: str = "") -> list[str]:
    """Names of the files of a folder, sorted; none if there is no such folder."""
    files, path = opened(folder)
    found = files.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted(f.base_name for f in found if f.is_file and f.base_name.endswith(ending) and f.base_name[0] not in "_.")


def put(folder: str, name: str, data: bytes) -> None:
    """A whole file or none: written under another name, then moved. What is there
    already was written by an earlier attempt and stays."""
    files, path = opened(folder)
    if files.get_file_info(f"{path}/{name}").is_file:
        return
    files.create_dir(path, recursive=True)
    part = f"{path}/_{name}-{uuid.uuid4().hex}"
    with files.open_output_stream(part, compression=None) as out:
        out.write(data)
    files.move(part, f"{path}/{name}")


def get(folder: str, name: str) -> bytes:
    files, path = opened(folder)
    with files.open_input_stream(f"{path}/{name}", compression=None) as f:
        return f.read()


def drop(folder: str, name: str) -> None:
    files, path = opened(folder)
    if files.get_file_info(f"{path}/{name}").is_file:
        files.delete_file(f"{path}/{name}")


def table_rows(folder: str, columns: list[str], size: int = 16) -> Iterator[pa.RecordBatch]:
    """The rows of a folder's Parquet files one by one, `size` in memory."""
    files, path = opened(folder)
    for name in names(folder, ".parquet"):
        with files.open_input_file(f"{path}/{name}") as f:
            for batch in pq.ParquetFile(f).iter_batches(size, columns=columns):
                for at in range(batch.num_rows):
                    yield batch.slice(at, 1)
