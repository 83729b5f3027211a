"""Fixed schemas of preprocessed samples, and the tensor triple that stands for a tensor in a row."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _B, _L, _D = T.StringType(), T.BinaryType(), T.LongType(), T.DoubleType()


def _tensor(*names: str) -> list[tuple]:
    return [x for n in names for x in ((f"{n}_bytes", _B), (f"{n}_shape", T.ArrayType(_L)), (f"{n}_dtype", _S))]


_INFO = [("file_name", _S), ("caption", _S), ("media_type", _S), ("width", _L), ("height", _L), ("num_frames", _L), ("duration_sec", _D), ("fps", _D)]
_NAMED = [("file_name", _S), ("caption", _S), ("media_type", _S)]
#: Columns of the six kinds of sample tables, in order.
KINDS = {
    "t2v": [("id", _S), *_tensor("vae_latent", "text_embedding"), *_INFO],
    "i2v": [("id", _S), *_tensor("vae_latent", "text_embedding", "clip_feature", "first_frame_latent", "pil_image"), *_INFO],
    "ode_trajectory_text_only": [("id", _S), *_tensor("text_embedding", "trajectory_latents", "trajectory_timesteps"), *_NAMED],
    "text_only": [("id", _S), *_tensor("text_embedding"), ("caption", _S)],
    "action": [("id", _S), *_tensor("vae_latent", "clip_feature", "first_frame_latent", "mouse_cond", "keyboard_cond", "pil_image"), *_INFO],
    "action_ode_trajectory": [("id", _S), *_tensor("clip_feature", "first_frame_latent", "pil_image", "mouse_cond", "keyboard_cond", "trajectory_latents", "trajectory_timesteps"), *_INFO],
}


def sample_schema(kind: str) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in KINDS[kind]])


def tensor_names(schema: T.StructType) -> list[str]:
    """Tensors of a schema: each field named *_bytes; its *_shape and *_dtype must stand beside it."""
    have = set(schema.fieldNames())
    names = [f[: -len("_bytes")] for f in schema.fieldNames() if f.endswith("_bytes")]
    for n in names:
        if not {f"{n}_shape", f"{n}_dtype"} <= have:
            raise ValueError(f"tensor {n} lacks its shape or dtype")
    return names


#: Defaults of a field that a record doesn't fill, by type.
DEFAULTS = {"string": "", "binary": b"", "bigint": 0, "double": 0.0, "array<bigint>": []}
