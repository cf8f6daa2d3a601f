"""Files of a folder as tasks see them: read and written in streams, listed, and concatenated in order."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow.fs


@dataclass(frozen=True)
class Store:
    """A folder or file of the machine, or of any store that Arrow opens by its address."""

    system: pyarrow.fs.FileSystem
    place: str

    def files(self, ending: str = "") -> Iterator[tuple[str, pyarrow.fs.FileSystem, str]]:
        """Name, file system and place of the files below, hidden ones left out; a file is its own only one."""
        info = self.system.get_file_info(self.place)
        if info.type == pyarrow.fs.FileType.File:
            found = [info]
        else:
            found = self.system.get_file_info(pyarrow.fs.FileSelector(self.place, allow_not_found=True, recursive=True))
        for x in sorted(found, key=lambda x: x.path):
            name = x.path[len(self.place) :].lstrip("/")
            hidden = any(part[:1] in "._" for part in name.split("/") if part)
            if x.type == pyarrow.fs.FileType.File and not hidden and x.path.endswith(ending):
                yield name, self.system, x.path


def store(path: str) -> Store:
    """A path without an address is one of the machine."""
    local = "://" not in path
    return Store(*pyarrow.fs.FileSystem.from_uri("file://" + path.removeprefix("file:") if local else path))
