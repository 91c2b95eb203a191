import contextlib
import io


def plan_of(frame):
    with contextlib.redirect_stdout(io.StringIO()) as out:
        frame.explain("formatted")
    return out.getvalue()
