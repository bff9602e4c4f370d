"""The README quick start runs as written."""

import re
from pathlib import Path

README = Path(__file__).resolve().parents[1] / "README.md"


def test_readme_quick_start_runs(spark):
    text = README.read_text(encoding="utf-8")
    section = text[text.index("## Quick start"):text.index("## Running")]
    code = re.search(r"```python\n(.*?)```", section, re.S).group(1)
    scope: dict = {}
    exec(compile(code, "README-quick-start", "exec"), scope)  # noqa: S102
    assert scope["history"].count() == 2
    assert scope["snapshot"].count() == 1
    assert scope["history"].where("__END_AT IS NULL").count() == 1
