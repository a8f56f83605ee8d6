"""The package as executors see it: imported from an archive, in a process that knows no other copy."""

import os
import subprocess
import sys

from fieldglean.rules import contacts, sites
from fieldglean.session import archive_package


def test_rule_tables_are_read_from_the_archive(tmp_path):
    archive = archive_package(str(tmp_path))
    # By a relative name, as in the folder of an executor.
    code = ("import sys; sys.path.insert(0, 'fieldglean.zip')\n"
            "from fieldglean.rules import contacts, sites\n"
            "print(contacts.__file__, len(contacts.catalogue()), len(sites.site_paths()))")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=60)
    assert out.returncode == 0, out.stderr
    origin, layouts, paths = out.stdout.split()
    assert os.path.basename(archive) in origin
    assert (int(layouts), int(paths)) == (len(contacts.catalogue()), len(sites.site_paths()))
