"""Detectors over C sources: which functions must be reported, which must not."""

import pytest

from weftgraph.frontend.minic import graph_of, parse
from weftgraph.graph import Graph
from weftgraph.operators import browse, catalog, detectors

# Small programs of our own: a message queue, an image loader, a log writer.
SOURCE = r"""
#include <stdlib.h>
struct message { struct message *next; char *body; int length; };

/* CWE-416: memory is read or passed on after it was given back */
int drop_then_count(struct message *m) {
  int total = 0;
  free(m);
  total = total + m->length;
  return total;
}
void log_after_drop(char *line, int level) {
  cfree(line);
  while (level > 0) { write_log(level, line); level = level - 1; }
}
void keep_view(char *line) { char *view = line; publish(view); free(line); forward(view, 2); }
void drop_head(struct message *list) { free(list->body); send_all(list->body, 1); }
void drop_or_send(char *packet, int broken) {
  switch (broken) { case 1: free(packet); break; default: send_all(packet, 9); }
}
void drop_in_case(char *packet, int kind) { switch (kind) { case 1: case 2: write_log(1, "x"); free(packet); send_all(packet, 9); break; default: write_log(2, "y"); } }
void drop_before_label(char *packet, int kind) { free(packet); switch (kind) { case 1: send_all(packet, 9); } }
void refill(char *packet) { send_all(packet, 1); free(packet); packet = next_packet(); send_all(packet, 2); }
void drop_last(char *packet, int n) { send_all(packet, n); write_log(n, packet); free(packet); }
int drop_and_leave(char *packet) { free(packet); return 0; send_all(packet, 3); }

/* CWE-415: given back twice */
void close_queue(struct message *m, int late) {
  char *body = m->body;
  free(body);
  write_log(late, "closed");
  if (late) { free(body); }
}
void two_names(char *raw) { char *image = raw; decode(image); free(raw); free(image); }
void drop_body_twice(struct message *m) { free(m->body); m->length = 0; free(m->body); }
void swap_buffers(char *front, char *back) { free(front); front = back; free(front); }
void one_way(char *raw, int ok) { if (ok == 0) { write_log(1, "bad"); free(raw); } else { decode(raw); free(raw); } }

/* CWE-476: the result of an allocation is used unseen */
void first_pixel(int width) { int *row = calloc(width, 4); row[0] = 255; }
void copy_name(struct message *m, char *name) { m = malloc(64); fill(m->body, name); }
int checked_row(int width) { int *row = calloc(width, 4); if (row == NULL) { return 1; } row[0] = 255; return 0; }
void row_if_there(int width) { int *row = calloc(width, 4); if (row != NULL) { row[0] = 1; } }
void row_of_caller(int width, int *given) { int *row = malloc(width); row = given; row[1] = 7; }
void pixel_after_abort(int width) { int *row = malloc(width); abort(); row[0] = 1; }
void pixel_after_message(int width) { int *row = malloc(width); warn("none"); row[0] = 1; }
void pixel_in_loop(int width, int n) { while (n > 0) { int *row = malloc(width); if (n == 3) { return; } row[0] = 1; n = n - 1; } }
void pixel_after_return(int width, int n) { if (n) { int *row = malloc(width); return; row[0] = 1; } }

/* CWE-457: read before it is set */
int sum_unset(int n) { int sum; if (n < 0) { write_log(sum, "none"); } sum = n; return sum; }
int sum_set(int *values, int n) { int sum = 0; for (int i = 0; i < n; i++) { sum = sum + values[i]; } return sum; }
int read_size(int file) { long size; ask_size(file, &size); return size; }

/* CWE-367: a path is looked at, then used */
void rotate(const char *log) { if (lstat(log, 0) == 0) { rename(log, "old.log"); } }
void remove_lock(void) { if (access("/run/app.lock", 2) == 0) { write_log(1, "stale"); unlink("/run/app.lock"); } }
void other_paths(const char *from, const char *to) { stat(from, 0); chmod(to, 6); }

/* CWE-122: more is written than was allocated */
void small_header(char *data) { char *header = calloc(24, 1); memmove(header, data, 40); }
void grown_too_little(char *old, char *data) { char *image = realloc(old, 64); memcpy(image, data, 80); }
void grown_enough(char *old, char *data) { char *image = realloc(old, 64); memcpy(image, data, 16); }
void any_title(char *title) { char *copy = malloc(80); strcat(copy, title); }
void by_length(char *data, int length) { char *copy = malloc(length); memcpy(copy, data, length); }
void guarded(char *data, int room, int want) { char *copy = malloc(room); if (want < room) { memcpy(copy, data, want); } }
void other_guard(char *data, int room, int n, int len) { char *copy = malloc(room); if (len < 3) { memcpy(copy, data, n); } }

/* CWE-121: more than a local array holds */
void banner(char *data) { char text[12]; memmove(text, data, 20); }
void greeting(char *name) { char text[32]; sprintf(text, "hello %s", name); }
void short_banner(char *data) { char text[40]; memmove(text, data, 20); }
void whole_banner(char *data) { char text[12]; strncpy(text, data, sizeof(text)); }
void room_seen(char *data, int n) { char text[16]; if (n < 16) { memcpy(text, data, n); } }
void room_unseen(char *data, int n, int k) { char text[16]; if (k < 16) { memcpy(text, data, n); } }
void one_less(char *data) { char text[16]; memcpy(text, data, 16 - 1); }
void by_limit(char *data) { char text[16]; memcpy(text, data, LIMIT); }

/* CWE-190: a product without a check becomes a size */
void pixels(int width, int height) { int bytes; bytes = width * height; char *p = malloc(bytes); use_it(&p); }
void pixels_at_once(int width, int height) { char *p = malloc(width * height); use_it(&p); }
void pixels_again(char *old, int width, int height) { int bytes; bytes = width * height; char *p = realloc(old, bytes); use_it(&p); }
void pixels_limit(int width, int height) { int bytes; if (width > SIZE_MAX / height) { return; } bytes = width * height; char *p = malloc(bytes); use_it(&p); }
void pixels_other_limit(int width, int height, int kind) { int bytes; if (kind == MAXKIND) { write_log(1, "x"); } bytes = width * height; char *p = malloc(bytes); use_it(&p); }
void rows_of_16(int n) { char *p = malloc(n * 16); use_it(&p); }
void size_first(int n) { char *p = malloc(sizeof(int) * n); use_it(&p); }
void shifted(int n) { char *p = malloc(n << 4); use_it(&p); }
void two_parts(int head, int body) { char *p = malloc(head + body); use_it(&p); }
void one_more(int n) { char *p = malloc(n + 1); use_it(&p); }
void far_more(int n) { char *p = malloc(n + 70000); use_it(&p); }
void inner_product(int n, int m) { char *p = malloc(pad + (n * m)); use_it(&p); }
void product_of_24(int n) { int t; t = n * 24; char *p = malloc(t); use_it(&p); }
void sum_before(int n, int m) { int t; t = n + m; char *p = malloc(t); use_it(&p); }
void divided(int n) { if (n > 9999 / 16) { return; } char *p = malloc(n * 16); use_it(&p); }
void divided_other(int n, int k) { if (k > 9999 / 16) { return; } char *p = malloc(n * 16); use_it(&p); }
void copied(char *title, int n) { char *p = strdup(title); use_it(&p); char *q = strndup(title, n * 2); use_it(&q); }
void sizes_only(void) { char *p = malloc(4 * sizeof(long)); use_it(&p); }
void fixed_size(void) { int bytes; bytes = 640 * 480; char *p = malloc(bytes); use_it(&p); }

void title_from_outside(int unit) { char *title = getenv("TITLE"); fprintf(unit, title); }
void title_given(char *title) { printf(title); }
void title_as_data(char *title) { printf("%s", title); }
void run_tool(char *tool) { popen(tool, "r"); popen("date", "r"); }

/* freed by another function */
void release(char *block) { free(block); }
void release_again(char *block) { free(block); release(block); }
void release_once(char *block) { write_log(1, block); release(block); }
"""

#: What each detector must report, and which of the others it must leave alone.
FIRES = {
    "use_after_free": ("drop_then_count log_after_drop keep_view drop_head drop_in_case drop_before_label", "drop_or_send refill drop_last drop_and_leave"),
    "double_free": ("close_queue two_names drop_body_twice", "swap_buffers one_way"),
    "null_deref": ("first_pixel copy_name pixel_after_message pixel_in_loop", "checked_row row_if_there row_of_caller pixel_after_abort pixel_after_return"),
    "uninitialized_read": ("sum_unset", "sum_set read_size"),
    "toctou": ("rotate remove_lock", "other_paths"),
    "heap_overflow": ("small_header grown_too_little any_title other_guard", "grown_enough by_length guarded"),
    "stack_overflow": ("banner greeting room_unseen by_limit", "short_banner whole_banner room_seen one_less"),
    "integer_overflow": ("pixels pixels_again pixels_other_limit product_of_24", "pixels_limit fixed_size sum_before"),
    "integer_overflow_direct": ("pixels_at_once rows_of_16 size_first shifted two_parts far_more inner_product divided_other", "pixels fixed_size one_more divided copied sizes_only sum_before"),
    "double_free_between_functions": ("release_again", "release_once release"),
}


@pytest.fixture(scope="module")
def graph(spark):
    return graph_of(spark.createDataFrame([("src/a.c", SOURCE)], "path string, text string"))[0]


@pytest.mark.parametrize("name", sorted(FIRES))
def test_matrix(spark, graph, name):
    found = detectors.DETECTORS[name][1](graph).select("method_id").distinct()
    names = {r.name for r in graph.method.join(found.withColumnRenamed("method_id", "id"), "id").collect()}
    fires, silent = (x.split() for x in FIRES[name])
    assert set(fires) <= names and names.isdisjoint(silent)


def test_sizes_have_the_risk_of_their_outermost_arithmetic(spark, graph):
    own = {r.id: r.name for r in graph.method.collect()}
    found = {own[r.method_id]: r for r in detectors.integer_overflow_sizes(graph).collect()}
    assert {k: (found[k].op, found[k].risk, found[k].arithmetic) for k in ("shifted", "two_parts", "inner_product", "product_of_24")} == {
        "shifted": ("left-shift", "HIGH", "n<<4"),
        "two_parts": ("addition", "MEDIUM", "head+body"),
        "inner_product": ("multiplication", "HIGH", "n*m"),
        "product_of_24": ("multiplication", "HIGH", "n*24"),
    }
    assert found["product_of_24"].issue_type == "alloc_indirect_arithmetic" and found["product_of_24"].size == "t"


def test_segments_of_switches(spark, graph):
    own = {r.id: r.name for r in graph.method.collect()}
    got = sorted((own[r.method_id], r.branch, r.line, r.line_end) for r in detectors.switch_segments(graph).collect())
    assert [(name, branch) for name, branch, _, _ in got] == [("drop_in_case", 1), ("drop_in_case", 2), ("drop_or_send", 1), ("drop_or_send", 2)]
    events = graph.call.select("method_id", "line", "name")
    ranges = {(name, a): b for name, _, a, b in got}
    for r in detectors.segment_of(graph, events).collect():
        last = [(a, b) for (name, a), b in ranges.items() if name == own[r.method_id] and a <= r.line <= b]
        assert own[r.method_id] == "drop_before_label" or last[0][0] == r.label


def test_formats_and_commands(spark, graph):
    own = {r.id: r.name for r in graph.method.collect()}
    place = {r.id: own[r.method_id] for r in graph.call.collect()}
    assert {(place[r.id], r.confidence) for r in detectors.format_string(graph).collect()} == {("title_from_outside", "HIGH"), ("title_given", "MEDIUM")}
    assert [place[r.id] for r in browse.command_sinks(graph, ["popen"]).collect()] == ["run_tool"]


def test_events_of_one_source_line(spark):
    """A graph whose lines are those of the source: what stands on one line is told apart by ids."""
    call = spark.createDataFrame([(1, 9, "free", 5), (2, 9, "puts", 5), (3, 8, "puts", 5), (4, 8, "free", 5), (5, 7, "free", 6), (6, 7, "free", 6)], "id long, method_id long, name string, line int").selectExpr("id", "method_id", "name", "name as code", "'a.c' as file", "line", "'' as dispatch_type", "cast(null as long) as callee_id")
    argument = call.selectExpr("id as call_id", "method_id", "1 as arg_index", "'IDENTIFIER' as kind", "'p' as code", "line", "cast(null as long) as decl_id")
    g = Graph.of(spark, {"call": call, "argument": argument})
    assert [(r.method_id, r.uses) for r in detectors.use_after_free(g).collect()] == [(9, 1)]
    assert [(r.site, r.second) for r in detectors.double_free(g).collect()] == [(5, 6)]


def test_findings_are_stored_by_codebase(spark, tmp_path):
    findings = spark.createDataFrame([(1, "a", "high"), (2, "b", "low")], "id long, codebase string, severity string")
    for _ in range(2):
        catalog.save_findings(findings, str(tmp_path / "f"))
    got = spark.read.parquet(str(tmp_path / "f"))
    assert got.count() == 4 and {p.name for p in (tmp_path / "f").iterdir() if p.is_dir()} == {"codebase=a", "codebase=b"}


def test_parts():
    rows = parse("x.c", "int f(int a, char *b)\n{\n  switch (a) {\n  case 1: g(b);\n  break;\n  default: h(b[a]);\n  }\n  do { a--; } while (a > 0);\n  return a;\n}\n")
    by = {}
    for name, row in rows:
        by.setdefault(name, []).append(row)
    assert [(p["name"], p["type_full_name"], p["ord"]) for p in by["parameter"]] == [("a", "int", 1), ("b", "char*", 2)]
    assert [b["line"] for b in by["label"]] == [3, 4] and {c["type"] for c in by["control"]} == {"SWITCH", "DO"}
    assert {c["name"] for c in by["call"]} >= {"g", "h", "<operator>.indirectIndexAccess"} and by["method"][0]["return_type"] == "int"
    assert {p["line"] for p in by["place"]} >= {4, 6, 9} and len(by["ret"]) == 1
    assert parse("y.c", "int broken( {") == [] and parse("z.c", "") == []
