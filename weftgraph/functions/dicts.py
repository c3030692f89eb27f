"""Name tables the analyses share.  Fixed values: results depend on exactly these names."""

# Fixed values.
EXTERNAL_INPUTS = "getenv fgets scanf read recv fread gets getchar fscanf recvfrom recvmsg getopt fopen getline getaddrinfo gethostbyname accept socket getpass realpath popen fdopen tmpfile dlopen".split()
TAINT_SOURCES = {
    "c": "getenv fgets scanf read recv fread gets getchar fscanf recvfrom recvmsg getopt getpass socket accept fopen getline realpath getaddrinfo gethostbyname".split(),
    "cpp": "getenv fgets scanf read recv fread gets getchar fscanf recvfrom recvmsg cin getline getopt".split(),
    "java": "getParameter getQueryString getHeader getCookie getReader getInputStream readLine readObject System.getenv System.getProperty Scanner.next Scanner.nextLine".split(),
    "python": "input raw_input sys.argv os.environ os.getenv request.args request.form request.json request.data request.cookies request.headers request.files".split(),
    "javascript": "req.body req.query req.params req.headers req.cookies process.env process.argv fs.readFile fetch prompt readline".split(),
    "go": (
        "os.Args os.Getenv os.Environ flag.String flag.Int net/http.Request.FormValue net/http.Request.Form net/http.Request.Header "
        "net/http.Request.Body net/http.Request.Cookies io/ioutil.ReadAll fmt.Scan fmt.Scanf"
    ).split(),
    "csharp": (
        "Console.ReadLine Console.Read System.Environment.GetEnvironmentVariable Request.QueryString Request.Form Request.Cookies Request.Headers "
        "Request.Params System.IO.File.ReadAllText System.Net.Sockets.Socket.Receive"
    ).split(),
    "php": "$_GET $_POST $_COOKIE $_REQUEST $_FILES $_SERVER $_ENV getenv file_get_contents fread fgets socket_read socket_recv".split(),
    "ruby": "gets read params ENV ARGV cookies request.body request.query_string request.headers".split(),
    "swift": "CommandLine.arguments ProcessInfo.processInfo.environment String(contentsOf:) Data(contentsOf:) URL(string:)".split(),
    "kotlin": "readLine Scanner.next System.getenv System.getProperty request.getParameter request.getHeader".split(),
    "jimple": "getParameter getQueryString getHeader getCookie getReader getInputStream readLine System.getenv".split(),
    "ghidra": "getenv fgets scanf read recv fread gets GetCommandLine GetEnvironmentVariable ReadFile Recv".split(),
}
TAINT_SINKS = {
    "c": "system popen execl execv execve execlp execvp sprintf fprintf snprintf vsprintf strcpy strcat gets memcpy memmove strncpy strncat free malloc printf syslog open fopen write send sendto".split(),
    "cpp": "system popen execl execv execve sprintf fprintf snprintf strcpy strcat memcpy memmove free malloc cout cerr".split(),
    "java": "Runtime.exec ProcessBuilder.start executeQuery executeUpdate sendRedirect forward include print write".split(),
    "python": "eval exec os.system os.popen subprocess.call subprocess.Popen subprocess.run pickle.load yaml.load sqlite3.execute".split(),
    "javascript": "eval setTimeout setInterval child_process.exec child_process.spawn fs.writeFile res.send res.render document.write innerHTML".split(),
    "go": "os/exec.Command syscall.Exec net/http.ResponseWriter.Write fmt.Printf fmt.Fprintf log.Fatal database/sql.DB.Query os.Create io/ioutil.WriteFile".split(),
    "csharp": (
        "System.Diagnostics.Process.Start System.Data.SqlClient.SqlCommand.ExecuteReader System.Data.SqlClient.SqlCommand.ExecuteNonQuery "
        "Response.Write System.IO.File.WriteAllText System.Console.WriteLine"
    ).split(),
    "php": (
        "exec shell_exec system passthru popen proc_open eval assert preg_replace echo print printf file_put_contents fwrite header setcookie mysql_query"
    ).split(),
    "ruby": "eval system exec syscall render send_file redirect_to print puts File.write ActiveRecord::Base.connection.execute".split(),
    "swift": "Process.launch Process() String(format:) print FileManager.default.createFile".split(),
    "kotlin": "Runtime.exec ProcessBuilder.start print println File.writeText rawQuery execSQL".split(),
    "jimple": "Runtime.exec ProcessBuilder.start executeQuery executeUpdate sendRedirect print write".split(),
    "ghidra": "system popen execl execv strcpy memcpy sprintf WinExec ShellExecute CreateProcess".split(),
}
SANITIZERS = {
    "c": "strlcpy strlcat snprintf vsnprintf strtol strtoul strtoll strtoull strtod atoi atol atof xmlEncodeEntities xmlEncodeSpecialChars htmlEncodeEntities".split(),
    "cpp": "strlcpy strlcat snprintf vsnprintf stoi stol stoul stod atoi atol atof".split(),
    "java": "escapeHtml escapeXml escapeSql escapeJavaScript encode parseInt parseLong parseDouble setString setInt setLong trim strip".split(),
    "python": "escape quote clean int float str".split(),
    "javascript": "encodeURIComponent encodeURI escapeHtml sanitize parseInt parseFloat Number".split(),
    "go": "EscapeString QueryEscape Atoi ParseInt ParseFloat Clean Base HTMLEscapeString".split(),
    "php": "htmlspecialchars htmlentities strip_tags addslashes mysqli_real_escape_string intval floatval filter_var filter_input urlencode rawurlencode".split(),
    "ruby": "sanitize h html_escape Integer Float".split(),
    "csharp": "HtmlEncode UrlEncode Escape TryParse ToInt32".split(),
    "swift": ["addingPercentEncoding"],
    "kotlin": "escapeHtml encode toInt toLong toDouble".split(),
}
COMMAND_SINKS = {
    "c": ["system", "popen", "execl", "execv", "execve", "execlp", "execvp", "execvpe"],
    "cpp": ["system", "popen", "execl", "execv", "execve"],
    "python": ["system", "popen", "call", "Popen", "run", "check_output", "check_call"],
    "javascript": ["exec", "execSync", "spawn", "spawnSync", "execFile"],
    "java": ["exec", "start"],
    "go": ["Command"],
    "php": ["exec", "shell_exec", "system", "passthru", "popen", "proc_open"],
    "ruby": ["system", "exec", "popen", "spawn"],
}
ALLOCATORS = "malloc calloc realloc strdup strndup aligned_alloc reallocarray fopen fdopen freopen tmpfile popen dlopen mmap".split()
HEAP_ALLOCATORS = "malloc calloc realloc strdup strndup aligned_alloc reallocarray".split()
#: Allocators of heap buffers and which argument is the size.
SIZE_ARGUMENT = dict.fromkeys("malloc calloc valloc pvalloc strdup strndup".split(), 1) | dict.fromkeys("realloc reallocarray aligned_alloc memalign posix_memalign".split(), 2)
#: Allocators whose size can overflow, and which argument it is.
OVERFLOW_SIZE = dict.fromkeys("malloc calloc reallocarray valloc pvalloc".split(), 1) | dict.fromkeys("realloc aligned_alloc memalign posix_memalign".split(), 2)
HIGH_RISK_OPERATORS = {"<operator>.multiplication": "multiplication", "<operator>.shiftLeft": "left-shift"}
MEDIUM_RISK_OPERATORS = {"<operator>.addition": "addition", "<operator>.subtraction": "subtraction"}
#: Calls that end the program.
EXITS = "exit abort _exit __assert_fail".split()
OVERFLOW_GUARDS = (
    "SIZE_MAX UINT_MAX ULONG_MAX INT_MAX LONG_MAX UINT32_MAX UINT64_MAX SSIZE_MAX RSIZE_MAX "
    "__builtin_mul_overflow __builtin_add_overflow __builtin_sub_overflow __builtin_umul_overflow __builtin_uadd_overflow "
    "safe_mul safe_add checked_mul checked_add ckd_mul ckd_add ckd_sub"
).split()
FORMAT_ARGUMENT = (
    dict.fromkeys("printf vprintf wprintf".split(), 1)
    | dict.fromkeys("fprintf vfprintf dprintf sprintf vsprintf syslog vsyslog err errx warn warnx asprintf vasprintf".split(), 2)
    | dict.fromkeys("snprintf vsnprintf".split(), 3)
)
FORMAT_TAINT = "getenv fgets scanf read recv fread gets getchar fscanf recvfrom recvmsg getopt getline getpass".split()
#: function: (destination argument, size argument; 0 is unbounded)
HEAP_WRITES = (
    dict.fromkeys("memcpy memmove memset strncpy strncat strlcpy strlcat".split(), (1, 3))
    | dict.fromkeys("snprintf vsnprintf".split(), (1, 2))
    | dict.fromkeys("strcpy strcat gets sprintf vsprintf".split(), (1, 0))
    | dict.fromkeys("read recv recvfrom".split(), (2, 3))
    | {"fread": (2, 0)}
)
STACK_WRITES = {k: v for k, v in HEAP_WRITES.items() if k not in ("recvfrom", "fread")}
PATH_CHECKS = "access stat lstat fstat faccessat euidaccess eaccess statx access64 stat64 lstat64".split()
PATH_USES = "open fopen freopen creat openat open64 fopen64 rename unlink unlinkat rmdir mkdir mkdirat chmod chown lchown fchmodat fchownat execve execvp execvpe execl execlp link linkat symlink symlinkat truncate truncate64".split()
DEREF_EXEMPT = "free cfree sizeof typeof assert __assert_fail exit abort _exit".split()
SEVERITIES = ["low", "medium", "high", "critical"]
# Patterns and weights by which a snippet's language is told.
LANGUAGE_SIGNALS = {
    "python": [(r"\bdef\s+\w+\s*\(", 2), (r"\bimport\s+\w+", 1), (r"\bself\b", 1), (r"\belif\b", 2), (r"__name__", 2), (r"\bprint\s*\(", 1), (r":\s*$", 1)],
    "c": [(r"#include\s*<\w+\.h>", 2), (r"\bint\s+main\s*\(", 1), (r"\bprintf\s*\(", 1), (r"\bmalloc\s*\(", 2), (r"\bstruct\s+\w+", 1), (r"\bsizeof\b", 1)],
    "cpp": [(r"\bstd::", 3), (r"\btemplate\s*<", 2), (r"\bnamespace\b", 2), (r"\bcout\b", 2), (r"\bnullptr\b", 2), (r"::\w", 1)],
    "java": [(r"\bpublic\s+class\b", 2), (r"\bimport\s+java\.", 3), (r"System\.out\.print", 2), (r"\bpackage\s+[\w.]+;", 2), (r"@Override", 2), (r"\bpublic\s+static\s+void\s+main", 2)],
    "javascript": [(r"\bfunction\s+\w*\s*\(", 1), (r"\bconst\s+\w+\s*=", 1), (r"\blet\s+\w+", 1), (r"=>", 1), (r"console\.log\s*\(", 2), (r"\brequire\s*\(", 2), (r"module\.exports", 2)],
    "go": [(r"\bpackage\s+\w+", 2), (r"\bfunc\s+\w*\s*\(", 1), (r":=", 2), (r"\bfmt\.", 2), (r"\bchan\b", 2)],
    "kotlin": [(r"\bfun\s+\w+\s*\(", 2), (r"\bval\s+\w+", 1), (r"\bimport\s+kotlin", 3), (r"\bprintln\s*\(", 1), (r":\s*Unit\b", 2)],
    "csharp": [(r"\busing\s+System", 3), (r"\bnamespace\s+\w+", 2), (r"Console\.Write", 2), (r"\bstatic\s+void\s+Main", 2)],
    "php": [(r"<\?php", 3), (r"\$\w+", 1), (r"\becho\b", 1), (r"->\w", 1)],
    "ruby": [(r"\bend\b", 1), (r"\bputs\b", 2), (r"\bdo\s*\|", 2), (r"\bnil\b", 1), (r"@\w+", 1), (r"\brequire\b", 1)],
    "swift": [(r"\bguard\b", 2), (r"\bimport\s+Swift", 3), (r"\bfunc\s+\w+\s*\(", 1), (r"\blet\s+\w+", 1), (r"\bvar\s+\w+\s*:", 1)],
    "rust": [(r"\bfn\s+\w+\s*\(", 2), (r"\blet\s+mut\b", 3), (r"\w+!\s*\(", 2), (r"\buse\s+std::", 3), (r"->\s*\w", 1), (r"\bimpl\b", 2), (r"#\[\w+", 2), (r"::\w", 1)],
}
# Paths (below the tree's root) that are left out of a graph, as patterns of the whole path.
EXCLUDED_PATHS = r"""
    (?:^|.*/)\..*
    (?:^|.*/)test.*
    (?:^|.*/)fuzz.*
    (?:^|.*/)Testing.*
    (?:^|.*/)spec.*
    (?:^|.*/)__tests__/.*
    (?:^|.*/)e2e.*
    (?:^|.*/)integration.*
    (?:^|.*/)unit.*
    (?:^|.*/)benchmark.*
    (?:^|.*/)perf.*
    (?:^|.*/)docs?/.*
    (?:^|.*/)documentation.*
    (?:^|.*/)example.*
    (?:^|.*/)sample.*
    (?:^|.*/)demo.*
    (?:^|.*/)tutorial.*
    (?:^|.*/)guide.*
    (?:^|.*/)build.*/.* (?:^|.*/).*_build/.*
    (?:^|.*/)target/.* (?:^|.*/)out/.*
    (?:^|.*/)dist/.* (?:^|.*/)bin/.*
    (?:^|.*/)obj/.* (?:^|.*/)Debug/.*
    (?:^|.*/)Release/.* (?:^|.*/)cmake/.*
    (?:^|.*/)m4/.* (?:^|.*/)autom4te.*/.*
    (?:^|.*/)autotools/.* (?:^|.*/)\.git/.*
    (?:^|.*/)\.svn/.* (?:^|.*/)\.hg/.*
    (?:^|.*/)\.deps/.* (?:^|.*/)node_modules/.*
    (?:^|.*/)vendor/.* (?:^|.*/)third_party/.*
    (?:^|.*/)extern/.* (?:^|.*/)external/.*
    (?:^|.*/)packages/.* (?:^|.*/)benchmark.*/.*
    (?:^|.*/)perf.*/.* (?:^|.*/)profile.*/.*
    (?:^|.*/)bench/.* (?:^|.*/)tool.*/.*
    (?:^|.*/)script.*/.* (?:^|.*/)utils/.*
    (?:^|.*/)util/.* (?:^|.*/)helper.*/.*
    (?:^|.*/)misc/.* (?:^|.*/)python/.*
    (?:^|.*/)java/.* (?:^|.*/)ruby/.*
    (?:^|.*/)perl/.* (?:^|.*/)php/.*
    (?:^|.*/)csharp/.* (?:^|.*/)dotnet/.*
    (?:^|.*/)go/.* (?:^|.*/)generated/.*
    (?:^|.*/)gen/.* (?:^|.*/)temp/.*
    (?:^|.*/)tmp/.* (?:^|.*/)cache/.*
    (?:^|.*/)\.cache/.* (?:^|.*/)log.*/.*
    (?:^|.*/)logs/.* (?:^|.*/)result.*/.*
    (?:^|.*/)results/.* (?:^|.*/)output/.*
    .*\.md$ .*\.txt$ .*\.xml$ .*\.json$ .*\.yaml$ .*\.yml$ .*\.toml$ .*\.ini$ .*\.cfg$ .*\.conf$ .*\.properties$ .*\.cmake$
    .*Makefile.* .*makefile.* .*configure.* .*\.am$ .*\.in$ .*\.ac$ .*\.log$ .*\.cache$ .*\.lock$ .*\.tmp$ .*\.bak$ .*\.orig$ .*\.swp$ .*~$
    .*/\.vscode/.* .*/\.idea/.* .*/\.eclipse/.* .*\.DS_Store$ .*Thumbs\.db$
""".split()


def short_names(patterns: list[str]) -> list[str]:
    """The last part of each dotted name, without an open bracket at its end; each once, in order."""
    return list(dict.fromkeys(p.rstrip("(").rpartition(".")[2] for p in patterns))


def names_for(language: str, default: dict[str, list[str]], configured: dict[str, list[str]] | None = None, given: list[str] | None = None) -> list[str]:
    """The names to look for: the caller's, else the configuration's for the language, else the default ones (of C if the language has none)."""
    chosen = given or (configured or {}).get(language.lower()) or default.get(language.lower()) or default["c"]
    return short_names(chosen)
