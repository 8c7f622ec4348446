"""Files that only one of several callers can make."""

from __future__ import annotations

import threading

from martloom.sources.files import Files


def test_one_of_many_makes_a_file(spark, tmp_path):
    files = Files(spark)
    for make in (files.create_new, files.publish_new):
        for n in range(25):
            path, gate, made = f"{tmp_path}/{make.__name__}/{n}.json", threading.Barrier(8), []

            def one(caller, path=path, gate=gate, made=made, make=make):
                gate.wait()
                if make(path, {"by": caller}):
                    made.append(caller)

            threads = [threading.Thread(target=one, args=(c,)) for c in range(8)]
            for t in threads:
                t.start()
            for t in threads:
                t.join()
            assert len(made) == 1 and files.read(path) == {"by": made[0]}
            assert not make(path, {"by": 9}) and files.read(path) == {"by": made[0]}
        assert len([f for f in files.names(f"{tmp_path}/{make.__name__}") if not f.endswith(".crc")]) == 25
