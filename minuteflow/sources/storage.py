"""File-system calls that tasks and the driver share, over ``pyarrow.fs``."""

from __future__ import annotations

import os
import uuid

from pyarrow import fs
from pyspark.sql import SparkSession


def qualify(spark: SparkSession, path: str) -> str:
    """Add the scheme of the cluster's default file system to a bare path."""
    if ":/" in path:
        return path.rstrip("/")
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
    if default.startswith("file:"):
        return path.rstrip("/")
    return default.rstrip("/") + path.rstrip("/")


def open_fs(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def hidden(name: str) -> bool:
    return name.startswith(("_", "."))


def children(path: str, recursive: bool = False) -> list[fs.FileInfo]:
    """Entries of a directory; none if it does not exist."""
    filesystem, inner = open_fs(path)
    return filesystem.get_file_info(
        fs.FileSelector(inner, allow_not_found=True, recursive=recursive)
    )


def subdirs(path: str, all_names: bool = False) -> list[str]:
    """Sorted names of sub-directories, without hidden ones unless ``all_names``."""
    return sorted(
        e.base_name
        for e in children(path)
        if e.type == fs.FileType.Directory and (all_names or not hidden(e.base_name))
    )


def exists(path: str) -> bool:
    filesystem, inner = open_fs(path)
    return filesystem.get_file_info(inner).type != fs.FileType.NotFound


def is_dir(path: str) -> bool:
    filesystem, inner = open_fs(path)
    return filesystem.get_file_info(inner).type == fs.FileType.Directory


def existing(spark: SparkSession, root: str) -> str:
    """A qualified root; a topic or a minute may be absent, a root must be there."""
    path = qualify(spark, root)
    if not exists(path):
        raise FileNotFoundError(f"no stream root {root}")
    return path


def make_dir(path: str) -> None:
    filesystem, inner = open_fs(path)
    filesystem.create_dir(inner, recursive=True)


def write_text(path: str, text: str) -> None:
    filesystem, inner = open_fs(path)
    filesystem.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    with filesystem.open_output_stream(inner) as out:
        out.write(text.encode())


def read_text(path: str) -> str:
    filesystem, inner = open_fs(path)
    with filesystem.open_input_stream(inner, compression=None) as src:
        return src.read().decode()


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole under a name nobody has yet; False if somebody has it.

    The text is written under a name of its own and put in place by a hard link, or on other file
    systems by a rename, which fails where the name is taken (HDFS).
    """
    own = f"{path.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}"
    write_text(own, text)
    filesystem, inner = open_fs(own)
    if isinstance(filesystem, fs.LocalFileSystem):
        try:
            os.link(inner, open_fs(path)[1])
        except FileExistsError:
            return False
        finally:
            os.unlink(inner)
        return True
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    source, target = hadoop(own), hadoop(path)
    files = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    # A rename onto an existing file fails; onto a missing one it is atomic.
    done = not files.exists(target) and files.rename(source, target)
    if not done:
        files.delete(source, False)
    return done


def delete_dir(path: str) -> None:
    filesystem, inner = open_fs(path)
    if filesystem.get_file_info(inner).type == fs.FileType.Directory:
        filesystem.delete_dir(inner)


def delete_file(path: str) -> None:
    filesystem, inner = open_fs(path)
    if filesystem.get_file_info(inner).type == fs.FileType.File:
        filesystem.delete_file(inner)


def move(src: str, dst: str) -> None:
    """Rename, safe to run again: a source already moved is left alone."""
    filesystem, src_inner = open_fs(src)
    dst_inner = open_fs(dst)[1]
    if filesystem.get_file_info(src_inner).type == fs.FileType.NotFound:
        if filesystem.get_file_info(dst_inner).type == fs.FileType.NotFound:
            raise FileNotFoundError(f"neither {src} nor {dst} exists")
        return
    filesystem.create_dir(dst_inner.rsplit("/", 1)[0], recursive=True)
    filesystem.move(src_inner, dst_inner)


def move_dir(src: str, dst: str) -> None:
    """Rename a directory as a whole, or fill one that already exists."""
    if exists(src) and exists(dst):
        for entry in children(src):
            move(f"{src}/{entry.base_name}", f"{dst}/{entry.base_name}")
        return
    try:
        move(src, dst)
    except OSError:
        if not exists(dst):
            raise
        for entry in children(src):
            move(f"{src}/{entry.base_name}", f"{dst}/{entry.base_name}")
