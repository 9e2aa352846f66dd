from prefspark.streaming.render import chatml_stream, render_turns_stream  # noqa: F401
