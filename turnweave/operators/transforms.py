"""Named dataset transforms: functions from DataFrame to DataFrame.

A transform that is a function over one example, ``fn(example, tokenizer=...)``, becomes one with :func:`row_transform`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import partial
from importlib import import_module

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from turnweave.functions import chat
from turnweave.operators import models
from turnweave.schemas import METADATA_COLUMNS

Transform = Callable[[DataFrame], DataFrame]


def messages_to_prompt(
    template: chat.ChatTemplate | None = chat.CHATML,
    keys: tuple[str, ...] = (),
    metadata: tuple[str, ...] = METADATA_COLUMNS,
    **_: object,
) -> Transform:
    """``messages`` → ``prompt``, with the metadata columns the input has.

    Assistant turns are dropped. With no template the prompt stays a message list.
    Options that only other transforms know are ignored.
    """

    def apply(df: DataFrame) -> DataFrame:
        asked = chat.without_assistant(F.col("messages"))
        if template is not None:
            asked = chat.render_prompt(asked, template)
        carried = [c for c in metadata if c in df.columns]
        return df.select(*keys, asked.alias("prompt"), *carried)

    return apply


def messages_to_query(
    template: chat.ChatTemplate | None = chat.CHATML,
    keys: tuple[str, ...] = (),
    ppo: bool = True,
    return_field: str | None = None,
    keep_metadata: bool = False,
    remove_columns: Sequence[str] | None = None,
) -> Transform:
    """The same under the name ``query`` and without metadata.

    ``return_field`` names the output; ``"prompt"``, or ``ppo=False``, keeps metadata.
    ``remove_columns`` are columns of the result that go.
    """
    field = return_field or ("query" if ppo else "prompt")

    def apply(df: DataFrame) -> DataFrame:
        prompts = messages_to_prompt(template, keys)(df)
        if field == "prompt":
            return prompts.drop(*(remove_columns or ()))
        carried = METADATA_COLUMNS if keep_metadata else ()
        kept = [c for c in prompts.columns if c in carried]
        return prompts.select(*keys, F.col("prompt").alias(field), *kept).drop(*(remove_columns or ()))

    return apply


def row_transform(
    name: str,
    factory: Callable[[], tuple[Callable[..., dict], dict]],
    schema: str | T.StructType,
    tokenizer: Callable[[], object] | None = None,
    keys: tuple[str, ...] = (),
) -> Transform:
    """A transform from a function over one example.

    ``factory`` gives the function and its options, of which ``remove_columns`` are left out of its
    results; it is called once per Python worker, and so is ``tokenizer``. An example is a dictionary of the row's
    values, with messages as lists of dictionaries. ``schema`` says which fields of the results are kept
    and of which type they are; one that a result lacks is null. ``keys`` are columns of the input
    that go along.
    """
    kinds = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    key = models.identity(name, factory)

    def apply(df: DataFrame) -> DataFrame:
        whole = T.StructType([*(df.schema[k] for k in keys), *(f for f in kinds if f.name not in keys)])
        arrow = to_arrow_schema(whole)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            function, options = models.once_per_worker(key, factory)
            removed = set(options.get("remove_columns") or ())
            read = models.once_per_worker(f"{key}-tokenizer", tokenizer) if tokenizer else None
            for batch in batches:
                examples = batch.to_pylist()
                made = [function(dict(example), tokenizer=read) for example in examples]
                columns = []
                for field in arrow:
                    source = examples if field.name in keys else made
                    gone = field.name in removed and field.name not in keys
                    columns.append(pa.array([None if gone else row.get(field.name) for row in source], field.type))
                yield pa.RecordBatch.from_arrays(columns, arrow.names)

        return df.mapInArrow(run, whole)

    return apply


TRANSFORMS: dict[str, Callable[..., Transform]] = {
    "messages_to_prompt": messages_to_prompt,
    "messages_to_query": messages_to_query,
}


def find(name: str, known: dict[str, Callable]) -> Callable:
    """A registered function, or one named by its dotted path."""
    if name in known:
        return known[name]
    module, dot, attribute = name.rpartition(".")
    if not dot:
        raise KeyError(f"unknown name {name!r}; known: {sorted(known)}")
    return getattr(import_module(module), attribute)


def transform_from_spec(spec: dict) -> Transform:
    """A transform from ``{"type": name, ...}``; other keys go to its factory.

    With ``schema`` the named factory is one of a function over single examples: it is called with the other keys
    and returns the function and its options, see :func:`row_transform`.
    """
    options = {k: v for k, v in spec.items() if k not in ("type", "path", "schema")}
    factory = find(spec["type"], TRANSFORMS)
    if "schema" in spec:
        return row_transform(spec["type"], partial(factory, cfg=None, **options), spec["schema"])
    return factory(**options)
