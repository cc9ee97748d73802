"""Files that tasks write to and read from the shared folder."""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import SparkSession

from keytide.session import shared_dir


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder of its own under the shared one; its files stay until ``remove``."""
    return f"{shared_dir(spark)}/keytide/{label}-{uuid.uuid4().hex[:12]}"


def locate(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def write_whole(path: str, parts: list) -> int:
    """Write a file so that it appears complete or not at all; returns its bytes.

    A task that runs again replaces what it wrote before.
    """
    system, place = locate(path)
    system.create_dir(place.rsplit("/", 1)[0], recursive=True)
    draft = f"{place}.{uuid.uuid4().hex[:8]}.draft"
    total = 0
    with system.open_output_stream(draft) as out:
        for part in parts:
            total += len(part)
            out.write(part)
    system.move(draft, place)
    return total


def open_file(path: str):
    system, place = locate(path)
    return system.open_input_file(place)


def list_files(path: str, suffix: str) -> list[tuple[str, int]]:
    """Files of a folder that end in ``suffix``, with their sizes, by name."""
    system, place = locate(path)
    scheme = path.split("://")[0] + "://" if "://" in path else ""
    found = system.get_file_info(fs.FileSelector(place, recursive=True, allow_not_found=True))
    if system.get_file_info(place).type == fs.FileType.File:
        found = [system.get_file_info(place)]
    return sorted((scheme + f.path, f.size) for f in found if f.type == fs.FileType.File and f.path.endswith(suffix))


def remove(path: str) -> None:
    system, place = locate(path)
    system.delete_dir(place)
