import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from gleanframe.session import build_session
from gleanframe.llm import html_text, language
spark = build_session("elsewhere", master="local[1]")
pages = spark.createDataFrame([(1, "u", "<p>text of a page")], "page_id long, url string, html string")
print("text:", html_text.extract(pages).first().text)
spark.stop()
"""


def test_tasks_find_the_package_from_any_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=200)
    assert "text: text of a page" in out.stdout, out.stderr[-2000:]
