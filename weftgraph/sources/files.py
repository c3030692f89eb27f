"""Source trees as tables: fingerprints, manifests, size scans, snippets, scopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.predicates import full_match, glob_regex

# Fixed values.
SCANNED_EXTENSIONS = "c h cc cpp cxx hh hpp java py js ts jsx tsx go kt cs php rb swift rs scala m mm sql sh pl lua txt".split()
SKIPPED_FOLDERS = ".git node_modules __pycache__ venv .venv build dist".split()


def files(spark: SparkSession, root: str, folder_glob: str | None = None) -> DataFrame:
    """path (below root), length, content of every file, without version-control folders."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if folder_glob:
        read = read.option("pathGlobFilter", folder_glob)
    below = F.regexp_replace(F.regexp_replace("path", r"^\w+:/*", "/"), "^" + F.regexp_replace(F.lit(root.rstrip("/") + "/"), r"([.^$*+?()\[{\\|])", r"\\$1"), "")
    return read.load(root).select(below.alias("path"), "length", "content").where(~F.col("path").rlike(r"(^|/)\.git/"))


def manifest(tree: DataFrame) -> DataFrame:
    """path, size, sha256 of each file."""
    return tree.select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def fingerprint(listed: DataFrame) -> DataFrame:
    """One row: files, bytes and the sha256 over sorted "path NUL sha256" lines.

    The lines of a tree, about a hundred bytes a file, meet in one task.
    """
    line = F.concat_ws("\u0000", "path", "sha256")
    return listed.agg(F.count("*").alias("file_count"), F.coalesce(F.sum("size"), F.lit(0)).alias("total_bytes"), F.sha2(F.array_join(F.sort_array(F.collect_list(line)), "\n"), 256).alias("digest"))


def scan(tree: DataFrame) -> DataFrame:
    """Megabytes and lines of text files outside dependency folders."""
    text = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(*SCANNED_EXTENSIONS)
    skipped = F.arrays_overlap(F.split("path", "/"), F.array(*map(F.lit, SKIPPED_FOLDERS)))
    lines = F.regexp_count(F.col("content").cast("string"), F.lit("\n"))
    return tree.where(text & ~skipped).agg(F.round(F.coalesce(F.sum("length"), F.lit(0)) / 1048576, 3).alias("megabytes"), F.coalesce(F.sum(lines), F.lit(0)).alias("lines"))


def snippets(texts: DataFrame, column: str = "text") -> DataFrame:
    """The texts' code blocks: language and bodies joined by a blank line; ``ok`` if there are some, all of one language."""
    block = r'(?s)<code\s+language="(\w+)"\s*>(.*?)</code>'
    got = texts.select("*", F.array_distinct(F.expr(f"regexp_extract_all({column}, '{block}', 1)")).alias("languages"), F.expr(f"regexp_extract_all({column}, '{block}', 2)").alias("bodies"))
    return got.select(*texts.columns, (F.size("languages") == 1).alias("ok"), F.try_element_at("languages", F.lit(1)).alias("language"), F.array_join(F.transform("bodies", F.trim), "\n\n").alias("code"))


def scoped(listed: DataFrame, keep: list[str], extensions: list[str]) -> DataFrame:
    """Files to build: those with other extensions (headers), and of these ones only what a glob keeps."""
    ours = full_match(F.col("path"), rf".*\.(?:{'|'.join(extensions)})")
    wanted = full_match(F.col("path"), "|".join(map(glob_regex, keep))) if keep else F.lit(True)
    return listed.where(~ours | wanted)


def include_folders(listed: DataFrame, most: int = 24, depth: int = 5) -> DataFrame:
    """Likely include folders: the root, include/, and those with config or version headers; shallow ones first."""
    folder = F.regexp_replace("path", r"/?[^/]*$", "")
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    likely = folder.rlike(r"(^|/)include$") | (name == "config.h") | name.rlike(r"version.*\.h$") | (folder == "")
    level = F.when(F.col("folder") == "", 0).otherwise(F.size(F.split("folder", "/")))
    return listed.where(likely).select(folder.alias("folder")).distinct().withColumn("level", level).where(F.col("level") <= depth).orderBy("level", "folder").limit(most)


# Where a compile database usually lies, and folders in which it is not looked for.
DATABASE_NAME = "compile_commands.json"
BUILD_FOLDERS = ["", "build", "out", "_build", "cmake-build-debug", "cmake-build-release", "Debug", "Release", "bin"]
UNSEARCHED_FOLDERS = [".git", ".svn", ".hg", "node_modules", ".cache"]


def compile_database(listed: DataFrame, depth: int = 3) -> DataFrame:
    """The path of the tree's compile database (no row if it has none): the largest, then the shallowest, then the first by name.

    One in a usual build folder goes before others, which may lie less than ``depth`` + 1 folders deep.  ``listed``: path, size.
    """
    folders = F.filter(F.split(F.regexp_replace("path", r"/?[^/]*\z", ""), "/"), lambda x: x != "")
    found = listed.where(F.regexp_extract("path", r"([^/]*)\z", 1) == DATABASE_NAME).select("path", "size", folders.alias("folders"))
    usual = F.array_join("folders", "/").isin(*BUILD_FOLDERS)
    near = (F.size("folders") <= depth) & ~F.arrays_overlap("folders", F.array(*map(F.lit, UNSEARCHED_FOLDERS)))
    return found.where(usual | near).orderBy(usual.desc(), F.desc("size"), F.size("folders"), "path").limit(1).select("path")


def rebased(path: Column, old: str, new: str) -> Column:
    """Absolute paths at or below ``old`` as paths below ``new``; others unchanged."""
    old, new = old.rstrip("/"), new.rstrip("/")
    return F.when((path == old) | path.startswith(old + "/"), F.concat(F.lit(new), F.substring(path, len(old) + 1, 1_000_000))).otherwise(path)
