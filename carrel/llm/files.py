"""Files of our own formats in the shared folder, whatever file system it is on."""

from __future__ import annotations

import uuid

from pyarrow import fs


def resolve(path: str) -> tuple[fs.FileSystem, str]:
    if "://" not in path and path.startswith("file:"):
        path = path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


def write_whole(path: str, data: bytes) -> None:
    """Writes a file under a name of its own and moves it into place.

    A task that runs again, or twice at once, replaces the file by the same bytes.
    """
    system, name = resolve(path)
    folder, _, leaf = name.rpartition("/")
    system.create_dir(folder, recursive=True)
    own = f"{folder}/.{leaf}.{uuid.uuid4().hex}"
    with system.open_output_stream(own) as out:
        out.write(data)
    system.move(own, name)


def read_range(path: str, offset: int, length: int) -> bytes:
    system, name = resolve(path)
    with system.open_input_file(name) as file:
        file.seek(offset)
        return file.read(length)


def read_whole(path: str) -> bytes:
    system, name = resolve(path)
    with system.open_input_file(name) as file:
        return file.read()
