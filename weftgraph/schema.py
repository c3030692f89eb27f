"""Declared schemas of the graph tables (never inferred)."""

from __future__ import annotations

TABLES: dict[str, str] = {
    "method": "id long, name string, full_name string, signature string, file string, line int, line_end int, is_external boolean, return_type string",
    "parameter": "id long, method_id long, name string, type_full_name string, ord int",
    "local": "id long, method_id long, name string, type_full_name string, line int",
    "call": "id long, method_id long, name string, code string, file string, line int, dispatch_type string, callee_id long",
    "argument": "call_id long, method_id long, arg_index int, kind string, code string, line int, decl_id long",
    "assignment": "id long, method_id long, line int, target string, source string",
    "control": "id long, method_id long, type string, condition string, line int, line_end int",
    "branch": "control_id long, method_id long, branch int, line int, line_end int",
    "label": "control_id long, method_id long, line int",
    "ret": "id long, method_id long, line int",
    "literal": "id long, method_id long, code string, type_full_name string, file string, line int",
    "type_decl": "id long, name string, full_name string, file string, line int",
    "member": "type_id long, name string, type_full_name string, ord int",
    "cfg": "src long, dst long, method_id long, label string",
    "ddg": "src long, dst long",
    "ast": "method_id long, root_id long, root_ord int, pre int, post int, parent int, ord int, kind string, name string, code string, line int",
    "cdg": "control_id long, call_id long",
}
